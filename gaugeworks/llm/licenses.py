"""License scan by diagonal voting.

Every word pair of every text meets the positions of that pair in the templates, as a Spark join. A hit at
word i of the text and word j of the template votes for the diagonal i - j. Votes are added up per
(text, template, diagonal). Diagonals are looked at in overlapping windows twice as wide as the template is long; there
those no more than ``DRIFT`` apart merge, so that a word more or less does no harm, and the merged span is
verified by the share of the template's pairs it covers. Pairs that repeat for long after a statement lie in later windows
and take nothing from it. A phrase stands at a place where one diagonal has all of its pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gaugeworks.llm.common import ascii_lower, null_safe, text_key
from gaugeworks.sources.scratch import materialise

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
DRIFT, COVER = 2, 0.6

#: Phrases that count wherever their words stand together.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

#: Templates of license statements, found in full or with small changes.
TEMPLATES = (
    ("this work is licensed under the gnu general public license version 3", "gpl"),
    ("you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gpl"),
    ("licensed under the apache license version 2 0", "apache"),
    ("you may not use this file except in compliance with the license", "apache"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("licensed under cc by nc 4 0", "cc-by"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl"),
    ("copyright all rights reserved", "reserved"),
)


def _positions(spark, phrases, templates) -> DataFrame:
    """A row per word pair of each phrase and template: a list whose length the lists above fix."""
    rows = []
    for number, (text, label, phrase) in enumerate([*[(t, n, True) for t, n in phrases], *[(t, n, False) for t, n in templates]]):
        own = text.split()
        rows += [(a, b, number, j, len(own), label, phrase) for j, (a, b) in enumerate(zip(own, own[1:], strict=False))]
    return spark.createDataFrame(rows, "first string, second string, template int, j int, n int, label string, phrase boolean").withColumn(
        "hash", F.xxhash64("first", "second"))


def words(text: Column) -> Column:
    """The words of a text, in order."""
    return F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))


def scanned(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Words are runs of lower-cased letters, digits and non-ASCII characters, numbered from 0. n_base counts
    the places of all phrases, first_word and last_word are their smallest and largest start (null without
    any). labels adds those of verified templates. score is the largest share of a phrase or template
    found, 0 to 1. Null and empty texts have no words. Rows that share a doc_id are told apart by their text;
    identical rows get identical results. Other columns are ignored; an empty table gives an empty result.

    Templates are a fixed list, so their side is broadcast. Votes are written to the shared folder. Only hits are grouped, by text and template, and only
    narrow rows are joined back.
    """
    spark = docs.sparkSession
    key = ["doc_id", "row_key"]
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("row_key", text_key(F.col("text")))
    # The words are a column of their own: inside the generator they would be taken three times.
    first = rows.select(*key, words(F.col("text")).alias("words")).select(*key, "words", F.slice("words", F.lit(2), F.greatest(F.size("words") - 1, F.lit(0))).alias("after"))
    rolled = first.select(*key, F.posexplode(F.arrays_zip("words", "after")).alias("i", "pair")).select(*key, "i", "pair.*")
    rolled = rolled.toDF(*key, "i", "word", "next").withColumn("hash", F.xxhash64("word", "next"))
    places = F.broadcast(_positions(spark, phrases, templates))
    hits = (rolled.join(places, "hash").where("word = first and next = second")
            .groupBy(*key, "template", "i", "j").agg(F.first("n").alias("n"), F.first("label").alias("label"), F.first("phrase").alias("phrase")))
    whose = [*key, "template", "n", "label", "phrase"]
    votes = hits.groupBy(*whose, (F.col("i") - F.col("j")).alias("diagonal")).agg(
        F.count(F.lit(1)).alias("votes"), F.min("i").alias("start"), F.collect_set("j").alias("found"))
    votes = materialise(votes, "votes")  # phrases and templates share one pass over the texts
    window = F.floor(F.col("diagonal") / F.col("n"))
    near = votes.where("not phrase").withColumn("window", F.explode(F.array(window, window - 1)))
    order = Window.partitionBy(*key, "template", "window").orderBy("diagonal")
    bands = near.withColumn("apart", (F.col("diagonal") - F.lag("diagonal").over(order) > DRIFT).cast("int")).withColumn(
        "band", F.sum(F.coalesce("apart", F.lit(0))).over(order))
    covered = F.size(F.array_distinct(F.flatten(F.collect_list("found"))))
    none = F.lit(None).cast("int")
    spans = bands.groupBy(*whose, "window", "band").agg(covered.alias("covered")).select(
        *key, "label", "phrase", none.alias("start"), (F.col("covered") / (F.col("n") - 1)).alias("share")).where(F.col("share") >= COVER)
    stands = votes.where("phrase and votes = n - 1").select(*key, "label", "phrase", "start", F.lit(1.0).alias("share"))
    found = spans.union(stands).groupBy(*key).agg(
        F.count_if("phrase").alias("n_base"), F.min("start").alias("first_word"), F.max("start").alias("last_word"),
        F.sort_array(F.collect_set(F.when(F.col("phrase"), F.col("label")))).alias("base_labels"),
        F.sort_array(F.collect_set("label")).alias("labels"), F.max("share").alias("score"))
    counted = rows.select(*key, F.regexp_count("text", F.lit(WORD.replace("x60", "x40\\x5B-\\x60"))).cast("long").alias("n_words"))
    return null_safe(counted, found, key, "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), F.col("first_word").cast("long"), F.col("last_word").cast("long"),
        F.coalesce(F.array_join("base_labels", ","), F.lit("")).alias("base_labels"), F.coalesce(F.array_join("labels", ","), F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
