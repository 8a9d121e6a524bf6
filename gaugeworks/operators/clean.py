"""Typing, grid alignment, de-duplication, names and the series contract."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from gaugeworks.functions.grid import (MICROS, epoch_micros, epoch_seconds, from_epoch_seconds,
                                       nearest_slot, off_grid)
from gaugeworks.functions.values import bad_angle, bad_measure, blank
from gaugeworks.operators.checks import issues, require_none
from gaugeworks.sources.readers import require_columns
from gaugeworks.spec import SeriesSpec

HELPERS = ("aligned_epoch", "shift_seconds")


def type_records(raw: DataFrame, s: SeriesSpec, source_value: str = "reading_value") -> DataFrame:
    """Trim ids, keep the source time as text, parse time, value and coordinates.

    Text that cannot be parsed becomes null, never an error.
    """
    return raw.withColumns({
        s.entity: F.trim(s.entity),
        "original_timestamp": F.col(s.time).cast("string"),
        "observation_time": F.try_to_timestamp(F.col(s.time)),
        s.value: F.col(source_value).try_cast("double"),
        s.latitude: F.col(s.latitude).try_cast("double"),
        s.longitude: F.col(s.longitude).try_cast("double"),
    })


def record_rules(s: SeriesSpec, time: str = "observation_time") -> dict[str, Column]:
    """Row validity rules on typed records."""
    return {
        "invalid_id": blank(s.entity),
        "invalid_time": F.col(time).isNull(),
        "invalid_value": bad_measure(s.value),
        "invalid_latitude": bad_angle(s.latitude, 90.0),
        "invalid_longitude": bad_angle(s.longitude, 180.0),
    }


def flag_invalid(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add ``invalid`` and ``broken_rules`` (comma-separated, in rule order)."""
    broken = F.concat_ws(",", *[F.when(rule, F.lit(name)) for name, rule in rules.items()])
    return df.withColumn("broken_rules", broken).withColumn("invalid", F.col("broken_rules") != "")


def align_to_grid(df: DataFrame, s: SeriesSpec, time: str = "observation_time") -> DataFrame:
    """Set ``s.time`` to the nearest slot, halfway up, and record the shift in seconds."""
    seconds = epoch_seconds(time)
    aligned = nearest_slot(seconds, s.slot_seconds)
    return df.withColumns({
        "aligned_epoch": aligned,
        "shift_seconds": aligned - seconds,
        s.time: from_epoch_seconds(aligned),
    })


def offset_rule(tolerance: int = 1, time: str = "observation_time") -> Column:
    return (F.abs("shift_seconds") > tolerance) | (F.pmod(epoch_micros(time), F.lit(MICROS)) != 0)


def check_offsets(df: DataFrame, tolerance: int = 1, time: str = "observation_time") -> DataFrame:
    """Aligned rows that moved too far or carry fractional seconds."""
    return df.where(offset_rule(tolerance, time))


def check_period(df: DataFrame, s: SeriesSpec, period: Column | int) -> DataFrame:
    """Aligned rows that left the year of their file."""
    return df.where(F.year(s.time) != (F.lit(period) if isinstance(period, int) else period))


def collision_stats(df: DataFrame, s: SeriesSpec, key: Sequence[str] | None = None) -> DataFrame:
    """Slots holding several rows: groups, extra rows, groups whose values disagree.

    Values disagree exactly when their minimum and maximum differ, so the count needs no
    distinct pass and each copy group is reduced before the shuffle.
    """
    per_slot = df.groupBy(*(key or s.key)).agg(
        F.count("*").alias("n"), F.min(s.value).alias("low"), F.max(s.value).alias("high"))
    many = F.col("n") > 1
    return per_slot.agg(
        F.count_if(many).alias("groups"),
        F.coalesce(F.sum(F.when(many, F.col("n") - 1)), F.lit(0)).alias("extras"),
        F.count_if(many & (F.col("low") != F.col("high"))).alias("conflicts"))


def keep_best_order(s: SeriesSpec, source_columns: Sequence[str]) -> list[str]:
    """Remaining tie columns: other source columns by name, then the coordinates."""
    skip = {s.entity, s.time, s.name, s.latitude, s.longitude, "original_timestamp"}
    return [*sorted(c for c in source_columns if c not in skip), s.latitude, s.longitude]


def dedupe_best(df: DataFrame, s: SeriesSpec, ties: Sequence[str],
                drop_helpers: bool = True) -> DataFrame:
    """Keep one row per slot: least absolute shift, then source time, then ``ties``, nulls last.

    The winner is the minimum of an ordered struct. That combines on the map side, so a
    slot holding most of the rows costs each task one row of shuffle, not a sort in one task.
    """
    key = [s.entity, "aligned_epoch"]
    ties = [c for c in dict.fromkeys(ties) if c not in (*key, "original_timestamp")]
    parts = [F.abs("shift_seconds").alias("_shift"), F.col("original_timestamp")]
    for c in ties:
        parts += [F.col(c).isNull().alias(f"_null_{c}"), F.col(c)]
    placed = {*key, "original_timestamp", *ties}
    parts += [F.col(c) for c in df.columns if c not in placed]
    best = df.groupBy(*key).agg(F.min(F.struct(*parts)).alias("_best"))
    out = best.select(*[F.col(c) if c in key else F.col(f"_best.{c}").alias(c) for c in df.columns])
    return out.drop(*HELPERS) if drop_helpers else out


def name_variants(raw: DataFrame, s: SeriesSpec) -> DataFrame:
    """Rows per id and name, ids trimmed and inner whitespace collapsed."""
    tidy = raw.select(
        F.trim(s.entity).alias(s.entity),
        F.regexp_replace(F.trim(s.name), r"\s+", " ").alias("original_name"))
    return (tidy.where((F.col(s.entity) != "") & (F.col("original_name") != ""))
            .groupBy(s.entity, "original_name").agg(F.count("*").alias("observations")))


def canonical_names(variants: DataFrame, s: SeriesSpec) -> DataFrame:
    """Mapping of every variant to the standard name of its id.

    Names that are more than the bare id win, then the most frequent, then alphabetical
    order without and with case.
    """
    bare = F.lower("original_name") == F.lower(s.entity)
    rank = F.struct(bare.alias("bare"), (-F.col("observations")).alias("rare"),
                    F.lower("original_name").alias("folded"), F.col("original_name").alias("standard_name"))
    chosen = variants.groupBy(s.entity).agg(F.min(rank).alias("best"))
    return (variants.join(chosen, s.entity)
            .select(s.entity, "original_name", F.col("best.standard_name").alias("standard_name"),
                    "observations",
                    (F.col("original_name") != F.col("best.standard_name")).cast("int").alias("name_changed")))


def name_dimension(mapping: DataFrame, s: SeriesSpec) -> DataFrame:
    return mapping.groupBy(s.entity).agg(F.min("standard_name").alias("standard_name"))


def apply_lookup(df: DataFrame, dim: DataFrame, s: SeriesSpec, keep_source: bool = False) -> DataFrame:
    """Replace the name by the standard one; flag renamed and unmapped rows.

    The join carries no hint: Spark broadcasts the dimension when its size allows, and
    otherwise adaptive execution splits an oversized id.
    """
    joined = df.join(dim, s.entity, "left")
    standard = F.col("standard_name")
    out = joined.withColumn("unmapped", standard.isNull()).withColumn(
        "name_changed", F.coalesce(F.col(s.name) != standard, F.lit(False)))
    if keep_source:
        out = out.withColumn("source_name", F.col(s.name))
    return out.withColumn(s.name, standard).drop("standard_name")


def cleaning_summary(named: DataFrame, s: SeriesSpec, period: str = "year") -> DataFrame:
    """Input rows, shifts, collisions, renamed rows and output rows per period.

    Takes aligned rows that passed :func:`apply_lookup`. All figures come from one
    aggregate by slot, so input minus output equals the removed rows by construction.
    """
    per_slot = named.groupBy(period, s.entity, "aligned_epoch").agg(
        F.count("*").alias("n"), F.count_if(F.col("shift_seconds") != 0).alias("moved"),
        F.count_if("name_changed").alias("renamed"))
    return per_slot.groupBy(period).agg(
        F.sum("n").alias("input_rows"), F.sum("moved").alias("shifted_timestamps"),
        F.count_if(F.col("n") > 1).alias("alignment_collision_groups"),
        F.sum(F.col("n") - 1).alias("collision_rows_removed"),
        F.sum("renamed").alias("station_name_rows_standardized"),
        F.count("*").alias("output_rows"))


def normalize(df: DataFrame, s: SeriesSpec, time_col: str = "auto") -> DataFrame:
    """Id, ``prediction_time`` and value; the aligned time is preferred to the observed one."""
    if time_col == "auto":
        time_col = s.time if s.time in df.columns else "observation_time"
    require_columns(df, [s.entity, s.value, time_col])
    time = F.col(time_col)
    if not dict(df.dtypes)[time_col].startswith("timestamp"):
        time = time.cast("timestamp")
    return df.select(F.col(s.entity).cast("string").alias(s.entity), time.alias("prediction_time"),
                     F.col(s.value).cast("double").alias(s.value))


def series_rules(s: SeriesSpec, years: tuple[int, int]) -> dict[str, Column]:
    """The row part of the series contract."""
    return {
        "invalid_id": blank(s.entity),
        "null_time": F.col(s.time).isNull(),
        "invalid_value": bad_measure(s.value),
        "off_grid": off_grid(s.time, s.slot_seconds),
        "outside_years": ~F.year(s.time).between(*years),
    }


def validate_series(df: DataFrame, s: SeriesSpec, years: tuple[int, int] = (2017, 2024),
                    year: int | None = None, nonempty: bool = False) -> DataFrame:
    """Broken rules of the series contract; an empty result means the series is valid.

    Row rules and the unique-key rule share one aggregate over (id, time).
    """
    rules = series_rules(s, (year, year) if year is not None else years)
    per_key = df.groupBy(*s.key).agg(
        F.count("*").alias("n"), *[F.count_if(r).alias(n) for n, r in rules.items()])
    names = [*rules, "duplicate_rows"]
    zero = F.lit(0).cast("long")
    totals = [F.coalesce(F.sum(n), zero).alias(n) for n in rules]
    totals.append(F.coalesce(F.sum(F.col("n") - 1), zero).alias("duplicate_rows"))
    if nonempty:
        names.append("empty_input")
        totals.append((F.count("*") == 0).cast("long").alias("empty_input"))
    return issues(per_key.agg(*totals), names)


def extract_subset(df: DataFrame, s: SeriesSpec, ids: Sequence[str], start: str, end: str) -> DataFrame:
    """Rows of some ids in a half-open time range."""
    return df.where(F.col(s.entity).isin(*ids) & (F.col(s.time) >= F.lit(start).cast("timestamp_ntz"))
                    & (F.col(s.time) < F.lit(end).cast("timestamp_ntz")))


def subset_coverage(subset: DataFrame, s: SeriesSpec, expected_rows: int) -> DataFrame:
    """Rows, span and wet readings per id, with the completeness verdict."""
    return subset.groupBy(s.entity).agg(
        F.count("*").alias("rows"), F.min(s.time).alias("first_time"), F.max(s.time).alias("last_time"),
        F.count_if(F.col(s.value) > 0).alias("wet_readings")
    ).withColumn("complete", F.col("rows") == expected_rows)


def clean_period(raw: DataFrame, s: SeriesSpec, dim: DataFrame, year: int, tolerance: int = 1) -> DataFrame:
    """One annual file from text to clean rows.

    Fails on an invalid record, an unexpected offset, a year crossing, an unmapped id or a
    conflicting slot. The checks are two aggregates; the result itself stays lazy.
    """
    aligned = align_to_grid(type_records(raw, s), s)
    named = apply_lookup(aligned, dim, s)
    require_none(named, {**record_rules(s), "unexpected_offset": offset_rule(tolerance),
                         "outside_year": F.year(s.time) != year, "unmapped": F.col("unmapped")},
                 f"Invalid records in {year}")
    require_none(collision_stats(named, s, [s.entity, "aligned_epoch"]),
                 {"conflicting_slots": F.col("conflicts") > 0}, f"Conflicting readings in {year}")
    best = dedupe_best(named, s, keep_best_order(s, raw.columns))
    return best.drop("unmapped", "name_changed")
