"""Structural validation of clean series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from gaugeworks.functions.grid import off_grid
from gaugeworks.functions.values import bad_angle, bad_measure, blank
from gaugeworks.operators.checks import issues, rule_counts
from gaugeworks.spec import SeriesSpec


def structural_rules(s: SeriesSpec, period: Column | int) -> dict[str, Column]:
    return {
        "invalid_station_ids": blank(s.entity),
        "invalid_station_names": blank(s.name),
        "null_timestamps": F.col(s.time).isNull(),
        "wrong_year": F.year(s.time) != (F.lit(period) if isinstance(period, int) else period),
        "off_grid": off_grid(s.time, s.slot_seconds),
        "invalid_rainfall": bad_measure(s.value),
        "invalid_coordinates": bad_angle(s.latitude, 90.0) | bad_angle(s.longitude, 180.0),
    }


def structural_counts(df: DataFrame, s: SeriesSpec, by: str = "year") -> DataFrame:
    """Rows, ids, span and failures of every structural rule, one row per period."""
    return rule_counts(df, structural_rules(s, F.col(by)), [by], [
        F.count("*").alias("rows"), F.count_distinct(s.entity).alias("stations"),
        F.min(s.time).alias("first_timestamp"), F.max(s.time).alias("last_timestamp")])


def duplicate_extras(df: DataFrame, key: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows beyond the first of each key."""
    per_key = df.groupBy(*by, *key).agg(F.count("*").alias("n"))
    return per_key.groupBy(*by).agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_extra_rows"))


def row_count_check(actual: DataFrame, expected: DataFrame, by: str = "year") -> DataFrame:
    """Actual rows beside the summary's; ``not_checked`` where the summary has none."""
    return actual.join(expected.select(by, F.col("output_rows").alias("expected_output_rows")), by, "left").withColumn(
        "row_count_matches_summary",
        F.when(F.col("expected_output_rows").isNull(), "not_checked")
        .otherwise((F.col("rows") == F.col("expected_output_rows")).cast("string")))


def validation_issues(counts: DataFrame, by: str = "year") -> DataFrame:
    """Failed checks in long form. Takes structural counts, joined with the other checks or not."""
    names = [c for c in (*structural_rules(SeriesSpec(), 0), "duplicate_extra_rows") if c in counts.columns]
    found = counts
    if "row_count_matches_summary" in counts.columns:
        found = found.withColumn("row_count_differs", (F.col("row_count_matches_summary") == "false").cast("long"))
        names.append("row_count_differs")
    found = found.withColumn("empty_dataset", (F.col("rows") == 0).cast("long"))
    return issues(found, [*names, "empty_dataset"], [by])


def metadata_exceptions(df: DataFrame, s: SeriesSpec, by: Sequence[str] = ()) -> DataFrame:
    """Ids with several names or coordinate pairs; a pair of nulls counts as a pair."""
    seen = df.groupBy(*by, s.entity, s.name, s.latitude, s.longitude).agg(F.lit(1).alias("seen"))
    return seen.groupBy(*by, s.entity).agg(
        F.count_distinct(s.name).alias("distinct_names"),
        F.count_distinct(F.struct(s.latitude, s.longitude)).alias("coordinate_pairs")
    ).where((F.col("distinct_names") > 1) | (F.col("coordinate_pairs") > 1))
