"""Writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from gaugeworks.sources.readers import period_path


def write_period(df: DataFrame, root: str, period: int, prefix: str = "rainfall_") -> str:
    """Replace one period folder and leave the others alone."""
    path = period_path(root, period, prefix)
    df.write.mode("overwrite").parquet(path)
    return path


def write_periods(df: DataFrame, path: str, by: str = "year") -> str:
    """All periods of one table in one job; only the periods present in ``df`` are replaced.

    Rebalancing by period keeps the number of files down and still splits a large period.
    """
    (df.hint("rebalance", by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(by).parquet(path))
    return path


def write_new_partitioned(df: DataFrame, path: str, by: Sequence[str] = ("split", "year")) -> DataFrame:
    """Write to a path that must not exist yet; return the counts read back from it."""
    df.hint("rebalance", *by).write.mode("errorifexists").partitionBy(*by).parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    return stored.groupBy(*by).agg(F.count("*").alias("rows"))


def write_sorted(df: DataFrame, path: str, keys: Sequence[str], files: int | None = None) -> str:
    """Sorted extract in range files whose names follow the order of the keys.

    ``files`` is the caller's choice; one file is one task, whatever its size.
    """
    ranged = df.repartitionByRange(*keys) if files is None else df.repartitionByRange(files, *keys)
    ranged.sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)
    return path


def write_summary_csv(df: DataFrame, path: str, keys: Sequence[str] = ()) -> str:
    """Summary table with a header, written by the executors."""
    out = df.orderBy(*keys) if keys else df
    out.write.mode("overwrite").option("header", True).csv(path)
    return path


def scored_output(pred: DataFrame, path: str) -> str:
    pred.write.mode("errorifexists").parquet(path)
    return path


def preview(pred: DataFrame, n: int = 200,
            order: Sequence[str] = ("prediction_time", "station_id", "threshold_mm")) -> DataFrame:
    """Ordered first rows; planned as a per-partition top-n followed by a merge."""
    return pred.orderBy(*order).limit(n)
