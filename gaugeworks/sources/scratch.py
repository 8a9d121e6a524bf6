"""Where intermediate tables go."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder that every executor reaches.

    It lies under the session's ``spark.checkpoint.dir``, or under its warehouse where that is unset.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/gaugeworks-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str = "table") -> DataFrame:
    """Cut lineage by writing a table to the shared folder and reading it back."""
    path = f"{scratch_dir(df.sparkSession)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
