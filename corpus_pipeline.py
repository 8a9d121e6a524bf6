"""A training-data pipeline over ``documents``: filter, de-duplicate, mix and pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again
as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gaugeworks.llm import convnet, fingerprints, jaccard, mixing, packing
from gaugeworks.llm.common import fresh, table, text_key, tokenizer_path
from gaugeworks.sources.scratch import materialise

#: No stage can be given as SQL as a whole: the first one trains a network.
ORACLE_SQL = None


def _one_each(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose (doc_id, row_key) is in ``chosen``; of identical rows one stays."""
    names = [fresh(docs, n) for n in ("row_key", "id", "no_id")]

    def keyed(df: DataFrame, key: Column) -> DataFrame:
        return df.withColumns(dict(zip(names, (key, F.coalesce("doc_id", F.lit(0)), F.col("doc_id").isNull()), strict=True)))

    wanted = keyed(chosen.select("doc_id", "row_key"), F.col("row_key")).select(*names).distinct()
    return keyed(docs, text_key(F.coalesce("text", F.lit("")))).join(wanted, names, "left_semi").dropDuplicates(names).drop(*names)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = convnet.train(docs, table(spark, sf_dir, "labels"))
    predicted = fresh(docs, "predicted")
    return convnet.scored(docs, model).where(F.col(predicted) == 1).select(*[F.col(f"`{c}`") for c in docs.columns])


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the one with the largest doc_id."""
    return _one_each(docs, fingerprints.duplicates(docs).where("kept"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of similar texts, the one with the smallest (doc_id, row_key); wordless ones stay.

    Similar are texts whose sets of five-word n-grams have a Jaccard similarity of 0.8 or more.
    """
    linked = jaccard.linked(docs, width=5, percent=80)
    return _one_each(docs, linked.where("first"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row per copy taken, in shuffled order within its shard."""
    places = fresh(docs, "places")
    return mixing.shuffled(mixing.mix(docs), places).select(*[F.col(f"`{c}`") for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES = [("quality classifier", quality), ("exact dedup", exact), ("n-gram jaccard join", near), ("mixing", mixed), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
