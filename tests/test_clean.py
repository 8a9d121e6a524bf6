from datetime import datetime

import pytest
from compare import rows
from pyspark.sql import functions as F

from gaugeworks.operators import checks, clean
from gaugeworks.spec import SeriesSpec
from gaugeworks.sources.readers import RAW_COLUMNS

S = SeriesSpec()


def raw(spark, *items):
    """(id, time, value) records with a name and a place."""
    data = [(i, "Somewhere", t, v, "1.3", "103.8") for i, t, v in items]
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in RAW_COLUMNS))


def aligned(spark, *items):
    return clean.align_to_grid(clean.type_records(raw(spark, *items), S), S)


def test_best_reading_is_the_one_on_the_grid(spark):
    df = aligned(spark, (" S1 ", "2017-05-01T11:59:59+08:00", "0.2"), ("S1", "2017-05-01T12:00:00+08:00", "0.2"),
                 ("S1", "2017-05-01T12:00:01+08:00", "0.2"))
    assert clean.check_offsets(df).isEmpty()
    stats = clean.collision_stats(df, S).first()
    assert (stats.groups, stats.extras, stats.conflicts) == (1, 2, 0)
    kept = clean.dedupe_best(df, S, clean.keep_best_order(S, RAW_COLUMNS))
    assert rows(kept.select("station_id", "original_timestamp", "timestamp")) == [
        ("S1", "2017-05-01T12:00:00+08:00", datetime(2017, 5, 1, 12))]


def test_halfway_rounds_up(spark):
    df = aligned(spark, ("S1", "2017-05-01 12:02:30", "1"), ("S1", "2017-05-01 12:02:29", "1"))
    assert sorted(r.timestamp.minute for r in df.collect()) == [0, 5]
    assert sorted(r.shift_seconds for r in df.collect()) == [-149, 150]


@pytest.mark.parametrize("value", ["Infinity", "-Infinity", "NaN", "-.2", None, "bad"])
def test_bad_value_is_flagged(spark, value):
    typed = clean.type_records(raw(spark, ("S1", "2017-05-01 12:00:00", value)), S)
    found = clean.flag_invalid(typed, clean.record_rules(S)).first()
    assert found.invalid and found.broken_rules == "invalid_value"


def test_all_bad_fields_are_named(spark):
    df = spark.createDataFrame([("  ", "n", "never", "1", "91", "nan")], ", ".join(f"{c} string" for c in RAW_COLUMNS))
    found = clean.flag_invalid(clean.type_records(df, S), clean.record_rules(S)).first()
    assert found.broken_rules == "invalid_id,invalid_time,invalid_latitude,invalid_longitude"


@pytest.mark.parametrize("time", ["2017-05-01 12:00:02", "2017-05-01 12:00:00.5"])
def test_offset_is_rejected(spark, time):
    assert not clean.check_offsets(aligned(spark, ("S1", time, "1"))).isEmpty()


def test_year_crossing_is_rejected(spark):
    df = aligned(spark, ("S1", "2017-12-31 23:59:59", "1"))
    assert not clean.check_period(df, S, 2017).isEmpty()
    assert clean.check_period(df, S, 2018).isEmpty()


def test_conflict_is_counted(spark):
    df = aligned(spark, ("S1", "2017-05-01 12:00:00", "0.2"), ("S1", "2017-05-01 12:00:01", "0.4"))
    assert clean.collision_stats(df, S).first().conflicts == 1


def test_nulls_lose_ties(spark):
    df = spark.createDataFrame([("S1", 0, 0, "t", None, 1.0), ("S1", 0, 0, "t", "z", 2.0), ("S1", 0, 1, "a", "a", 3.0)],
                               "station_id string, aligned_epoch long, shift_seconds long, original_timestamp string, "
                               "extra string, rainfall double")
    assert rows(clean.dedupe_best(df, S, ["extra"]).select("extra", "rainfall")) == [("z", 2.0)]


def test_canonical_name_prefers_description_then_frequency(spark):
    data = ([("S1", "S1")] * 5 + [("S1", "North  Road")] * 2 + [("S1", "NORTH ROAD")] * 2 + [("S1", "Old Name")]
            + [("S2", " S2 ")] + [(None, "x"), ("S3", "  ")])
    names = clean.name_variants(spark.createDataFrame(data, "station_id string, station_name string"), S)
    mapping = clean.canonical_names(names, S)
    assert {r.station_id: r.standard_name for r in mapping.collect()} == {"S1": "NORTH ROAD", "S2": "S2"}
    assert {r.original_name: r.name_changed for r in mapping.where("station_id = 'S1'").collect()} == {
        "S1": 1, "North Road": 1, "NORTH ROAD": 0, "Old Name": 1}


def test_unmapped_id_stops_cleaning(spark):
    df = raw(spark, ("S1", "2017-05-01 12:00:00", "0.2"))
    dim = spark.createDataFrame([("S9", "Nine")], "station_id string, standard_name string")
    with pytest.raises(ValueError, match="unmapped"):
        clean.clean_period(df, S, dim, 2017)


def test_clean_period_end_to_end(spark):
    df = raw(spark, ("S1", "2017-05-01 00:00:00", "0.2"), ("S1", "2017-05-01 00:00:01", "0.2"),
             ("S1", "2017-05-01 00:10:00", "0.4"))
    dim = spark.createDataFrame([("S1", "One")], "station_id string, standard_name string")
    out = clean.clean_period(df, S, dim, 2017)
    assert out.count() == 2 and out.agg(F.round(F.sum("rainfall"), 6)).first()[0] == 0.6
    assert {r.station_name for r in out.collect()} == {"One"}
    with pytest.raises(ValueError, match="conflicting_slots"):
        clean.clean_period(raw(spark, ("S1", "2017-05-01 00:00:00", "0.2"), ("S1", "2017-05-01 00:00:01", "0.4")), S, dim, 2017)
    doubled = out.unionByName(out)
    found = {r.issue: r.failures for r in clean.validate_series(doubled, S).collect()}
    assert found == {"duplicate_rows": 2}
    assert clean.validate_series(out, S, year=2017, nonempty=True).isEmpty()
    assert {r.issue for r in clean.validate_series(out.limit(0), S, nonempty=True).collect()} == {"empty_input"}


def test_zone_aware_text_uses_the_session_zone(spark):
    df = aligned(spark, ("S1", "2017-12-31T16:00:00Z", "1"))
    assert df.first().timestamp == datetime(2018, 1, 1)


def test_require_helpers(spark):
    one = spark.range(1)
    checks.require_empty(one.where("id > 5"), "no")
    with pytest.raises(ValueError, match="some"):
        checks.require_empty(one, "some")


def test_normalize_picks_the_time_column(spark):
    df = spark.sql("SELECT 'S1' AS station_id, timestamp'2017-01-01' AS observation_time, '1.5' AS rainfall")
    assert clean.normalize(df, S).columns == ["station_id", "prediction_time", "rainfall"]
    with pytest.raises(ValueError, match="Missing columns"):
        clean.normalize(df, S, "timestamp")
