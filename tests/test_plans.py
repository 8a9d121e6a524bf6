"""Plan shapes that must hold at any scale."""

import re

import pytest
from pyspark.sql import functions as F

from gaugeworks.operators import clean, evaluate, features, gaps, profile, ranking
from gaugeworks.plans import bindings as b

SF = "/root/testdata/sf0.001"


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_windows_run_inside_blocks(spark):
    plan = executed(features.slot_features(b.dense(spark, SF), b.HOUR))
    assert re.search(r"Window \[.*\], \[station_id#\d+, _block#\d+L?\]", plan)
    assert plan.count("Window [") == 1


def test_intervals_share_one_merge(spark):
    plan = executed(gaps.intervals(b.aligned(spark, SF), b.DAY, time="observation_time", within=["year"]))
    assert "ReusedExchange" in plan and plan.count("FileScan") == 1


def test_long_gaps_parse_times_once_and_share_the_shuffle_of_a_block(spark):
    df = spark.createDataFrame([("a", f"2020-01-{d:02} 00:00:0{d % 2}") for d in (1, 2, 5, 9)], "station_id string, text string")
    times = df.withColumn("timestamp", F.try_to_timestamp("text").cast("timestamp_ntz"))
    found = gaps.longest_gaps(gaps.missing_slots(gaps.intervals(times, b.DAY), b.DAY), b.DAY)
    plan = executed(found)
    # The text is parsed for the merge and in no condition; nothing is looked for inside a second.
    assert not [line for line in plan.splitlines() if "Filter" in line and "text" in line]
    assert len(re.findall(r"Window \[", plan)) == 2 and "second" not in "".join(re.findall(r"windowspecdefinition\((.*?) ASC", plan))
    # Steps of a block go through one shuffle, for their window and for the ends of the block.
    blocks = [line for line in plan.splitlines() if re.search(r" Exchange hashpartitioning\(.*block#", line) and "Reused" not in line]
    assert len(blocks) == 1 and "ReusedExchange" in plan
    assert [(r.ts.day, r.gap_seconds, r.estimated_missing_slots) for r in found.collect()] == [
        (9, 4 * 86_400, 3), (5, 3 * 86_400 + 1, 3)]


def test_span_coverage_and_profile_scan_once(spark):
    pairs, ends = gaps.intervals_and_ends(b.aligned(spark, SF), b.DAY, time="observation_time", within=["year"])
    plan = executed(gaps.span_coverage_raw(ends, gaps.missing_slots(pairs, b.DAY), b.DAY, ["year"]))
    assert plan.count("FileScan") == executed(b.aligned(spark, SF)).count("FileScan")
    tables = profile.profile(b.dirty(spark, SF), b.DAY, "year", ["station_id"])
    assert executed(tables).count("FileScan") == executed(b.dirty(spark, SF)).count("FileScan")


def test_copies_shrink_before_the_shuffle(spark):
    plan = executed(clean.dedupe_best(b.event_slots(spark, SF), b.HOUR, ["event_id"]))
    assert "partial_min" in plan and "Window [" not in plan


def test_areas_share_one_count_of_scores(spark):
    plan = executed(evaluate.auc_rank(b.scores(spark, SF)))
    assert "ReusedExchange" in plan and plan.count("FileScan") == 1


def test_top_rows_are_cut_before_the_shuffle(spark):
    df = spark.range(1000).withColumn("g", F.col("id") % 3)
    assert "WindowGroupLimit" in executed(ranking.top_rows(df, 2, [F.col("id")], ["g"]))
    assert "TakeOrderedAndProject" in executed(ranking.top_rows(df, 2, [F.col("id")]))


@pytest.mark.parametrize("make, needed", [
    (b.daily, {"l_orderkey", "l_suppkey", "l_shipdate", "l_quantity"}),
    (b.dense, {"event_id", "event_type", "ts", "value"})])
def test_scans_read_only_needed_columns(spark, make, needed):
    plan = make(spark, SF)._jdf.queryExecution().executedPlan().toString()
    big = max(re.findall(r"ReadSchema: struct<([^>]*)>", plan), key=len)
    assert {c.split(":")[0] for c in big.split(",")} <= needed


def test_profile_state_is_keyed_without_the_parsed_time(spark):
    """Id, time text and period tell rows of a state apart; what follows from them is not shuffled."""
    rows = [(2023, "S1", "2023-01-01 00:00:00", "1"), (2023, "S1", "2023-01-01 00:00:00", None), (2023, None, "no time", "2"),
            (2023, " ", None, "x"), (2023, "S1", "no time", "3")]
    raw = spark.createDataFrame(rows, "year int, station_id string, timestamp string, reading_value string")
    table = profile.profile(raw, b.DAY, "year", ["station_id", "timestamp", "reading_value"])
    keys = re.findall(r"hashpartitioning\(([^)]*timestamp#[^)]*)\)", executed(table))
    assert keys and not any("observation_time" in k for k in keys)
    got = table.first()
    assert (got.total_rows, got.invalid_timestamps, got.missing_station_id, got.missing_timestamp, got.missing_reading_value) == (5, 2, 2, 1, 1)
