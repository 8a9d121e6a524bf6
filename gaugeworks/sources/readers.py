"""Scans: typed late, pruned early."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from gaugeworks.functions.values import any_of, non_finite
from gaugeworks.spec import LABEL_THRESHOLDS, SPLITS

RAW_COLUMNS = ("station_id", "station_name", "timestamp", "reading_value",
               "location_latitude", "location_longitude")
RAINFALL_FEATURES = ("rainfall_previous_5m", "rainfall_previous_30m", "rainfall_previous_60m")
FEATURE_COLUMNS = ("station_id", "prediction_time", "hour", "month", *RAINFALL_FEATURES)
# Column names of the alternative example layout.
EXAMPLE_ALIASES = {"timestamp": "prediction_time", "past_5m_mm": "rainfall_previous_5m",
                   "past_30m_mm": "rainfall_previous_30m", "past_60m_mm": "rainfall_previous_60m"}


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"Missing columns: {missing}")
    return df


def read_raw_csv(spark: SparkSession, path: str | Sequence[str],
                 required: Sequence[str] = RAW_COLUMNS,
                 columns: Sequence[str] | None = None) -> DataFrame:
    """Every column as text. Give ``columns`` (in file order) to skip the header job."""
    reader = spark.read.option("header", True).option("inferSchema", False)
    if columns is not None:
        reader = reader.schema(StructType([StructField(c, StringType()) for c in columns]))
    paths = [path] if isinstance(path, str) else list(path)
    return require_columns(reader.csv(paths), required)


def period_path(root: str, period: int, prefix: str = "rainfall_") -> str:
    return f"{root.rstrip('/')}/{prefix}{period}"


def read_series(spark: SparkSession, root: str, periods: Iterable[int],
                prefix: str = "rainfall_", existing_only: bool = False) -> DataFrame:
    """One scan over several period folders; all must exist unless ``existing_only``.

    With a prefix like ``year=`` the folders are partitions, and the period is read as a column.
    """
    paths = [period_path(root, p, prefix) for p in periods]
    if existing_only:
        # A pattern skips the folders that are absent and still fails when none is there.
        names = ",".join(path.rsplit("/", 1)[1] for path in paths)
        paths = [f"{root.rstrip('/')}/{{{names}}}"]
    reader = spark.read.option("basePath", root) if prefix.endswith("=") else spark.read
    return reader.parquet(*paths)


def read_split(spark: SparkSession, root: str, split: str, schema: StructType | None = None) -> DataFrame:
    """Partition-pruned scan of one split. A known schema also serves a table without rows."""
    if split not in SPLITS:
        raise ValueError(f"Unknown split: {split}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(root).where(F.col("split") == split)


def adapt_examples(df: DataFrame, thresholds: Sequence[float] = LABEL_THRESHOLDS,
                   labelled: bool | None = None) -> DataFrame:
    """Bring prepared rows or ready examples to the one training layout.

    Rows with an unusable input are dropped. Prepared rows are expanded over the
    thresholds; ready examples keep theirs and get an ``invalid_example`` flag instead.
    """
    labelled = "label" in df.columns if labelled is None else labelled
    if labelled:
        df = df.withColumnsRenamed({k: v for k, v in EXAMPLE_ALIASES.items() if k in df.columns})
        needed = [*FEATURE_COLUMNS, "threshold_mm", "label"]
    else:
        needed = [*FEATURE_COLUMNS, "future_rainfall_30m"]
    require_columns(df, needed)
    measures = [c for c in needed if c.startswith(("rainfall_", "future_")) or c in ("threshold_mm", "label")]
    df = df.dropna(subset=needed).where(~any_of(non_finite(c) for c in measures))
    if labelled:
        wrong = ~F.col("label").isin(0.0, 1.0) | ~F.col("threshold_mm").isin(*map(float, thresholds))
        return df.select(*FEATURE_COLUMNS, "threshold_mm", "label", wrong.alias("invalid_example"))
    return (df.withColumn("threshold_mm", F.explode(F.array(*[F.lit(float(t)) for t in thresholds])))
            .withColumn("label", (F.col("future_rainfall_30m") > F.col("threshold_mm")).cast("double"))
            .select(*FEATURE_COLUMNS, "threshold_mm", "label"))
