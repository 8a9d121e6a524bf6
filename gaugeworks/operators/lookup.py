"""Point-in-time features and outcomes for tables of requests.

A request table holds ``request_id``, the id column, ``prediction_time`` and
``threshold_mm``. Readings are reduced to one row per (id, slot), and only those rows meet the
requests' slots through equal keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from gaugeworks.functions.grid import epoch_seconds, floor_div, from_epoch_seconds, off_grid
from gaugeworks.functions.values import bad_measure
from gaugeworks.operators.features import _sum_in_order
from gaugeworks.sources.readers import RAINFALL_FEATURES
from gaugeworks.spec import FUTURE_SLOTS, LABEL_THRESHOLDS, PAST_SLOTS, SeriesSpec


def normalize_requests(requests: DataFrame, s: SeriesSpec, thresholds: Sequence[float] = LABEL_THRESHOLDS,
                       years: tuple[int, int] = (2017, 2024)) -> DataFrame:
    """Add ``status``: ``ok`` or the first reason to reject the request."""
    allowed = F.coalesce(F.col("threshold_mm").isin(*map(float, thresholds)), F.lit(False))
    status = (F.when(F.col(s.entity).isNull() | F.col("prediction_time").isNull(), "incomplete_request")
              .when(~F.year("prediction_time").between(*years), "outside_years")
              .when(off_grid("prediction_time", s.slot_seconds), "off_grid")
              .when(~allowed, "unsupported_threshold").otherwise("ok"))
    return requests.withColumn("status", status)


def _moments(requests: DataFrame, s: SeriesSpec) -> DataFrame:
    """Distinct (id, time) of the accepted requests, with the request's slot number."""
    accepted = requests.where(F.col("status") == "ok")
    return (accepted.select(s.entity, "prediction_time").distinct()
            .withColumn("_at", floor_div(epoch_seconds("prediction_time"), s.slot_seconds)))


def _slot_facts(moments: DataFrame, obs: DataFrame, s: SeriesSpec, offsets: Sequence[int]) -> DataFrame:
    """Per (id, time, offset): readings on the slot, their value, and what is wrong with them.

    Off-grid readings belong to the slot they fall into, except past the end of the window.
    """
    seconds = epoch_seconds(s.time)
    off, bad = off_grid(s.time, s.slot_seconds), bad_measure(s.value)
    prompt = F.pmod(seconds, F.lit(s.slot_seconds)) == 0
    slots = obs.groupBy(s.entity, floor_div(seconds, s.slot_seconds).alias("_slot")).agg(
        F.count_if(~off).alias("_n"), F.max(F.when(~off, F.col(s.value))).alias("_v"),
        F.count_if(off).alias("_off"), F.count_if(off & prompt).alias("_off_prompt"),
        F.count_if(bad).alias("_bad"), F.count_if(bad & prompt).alias("_bad_prompt"))
    wanted = moments.select("*", F.explode(F.array(*[F.lit(o) for o in offsets])).alias("_offset")).withColumn(
        "_slot", F.col("_at") + F.col("_offset"))
    inner = F.col("_offset") < max(offsets)
    return wanted.join(slots, [s.entity, "_slot"]).select(
        s.entity, "prediction_time", "_offset", "_n", "_v",
        F.when(inner, F.col("_off")).otherwise(F.col("_off_prompt")).alias("_misaligned"),
        F.when(inner, F.col("_bad")).otherwise(F.col("_bad_prompt")).alias("_unusable"))


def _quality(facts: DataFrame, s: SeriesSpec, extra: Sequence[Column] = ()) -> DataFrame:
    return facts.groupBy(s.entity, "prediction_time").agg(
        F.sum(F.greatest(F.col("_n") - 1, F.lit(0))).alias("duplicate_readings"),
        F.sum("_misaligned").alias("misaligned_readings"), F.sum("_unusable").alias("unusable_readings"), *extra)


def _value(offset: int) -> Column:
    return F.max(F.when(F.col("_offset") == offset, F.col("_v")))


def _has(offset: int) -> Column:
    return F.count_if((F.col("_offset") == offset) & (F.col("_n") > 0)) > 0


def _bad_window() -> Column:
    return (F.col("duplicate_readings") + F.col("misaligned_readings") + F.col("unusable_readings")) > 0


def window_quality(requests: DataFrame, obs: DataFrame, s: SeriesSpec, past: int = PAST_SLOTS) -> DataFrame:
    """Duplicate, misaligned and unusable readings in the history window of each request."""
    counts = ["duplicate_readings", "misaligned_readings", "unusable_readings"]
    facts = _slot_facts(_moments(requests, s), obs, s, range(-past, 1))
    found = _quality(facts, s)
    zero = F.lit(0).cast("long")
    out = requests.join(found, [s.entity, "prediction_time"], "left")
    return out.select("request_id", s.entity, "prediction_time", "status",
                      *[F.coalesce(F.col(c), zero).alias(c) for c in counts])


def lookup_features(requests: DataFrame, obs: DataFrame, s: SeriesSpec, past: int = PAST_SLOTS,
                    with_history: bool = False) -> DataFrame:
    """Training features for each request, from readings at or before its time only.

    The reading at t must exist but enters no sum. Rejected requests keep their reason.
    """
    facts = _slot_facts(_moments(requests, s), obs, s, range(-past, 1))
    history = [F.count_if((F.col("_offset") < 0) & (F.col("_n") > 0)).alias("_held"), _has(0).alias("_now"),
               *[_value(-i).alias(f"_p{i}") for i in range(1, past + 1)]]
    if with_history:
        point = F.struct((F.col("_offset") * s.slot_seconds / 60).cast("int").alias("minutes"),
                         from_epoch_seconds(epoch_seconds("prediction_time") + F.col("_offset") * s.slot_seconds)
                         .alias("time"), F.col("_v").alias("value"))
        history.append(F.sort_array(F.collect_list(F.when(F.col("_offset") < 0, point))).alias("history"))
    found = _quality(facts, s, history)
    out = requests.join(found, [s.entity, "prediction_time"], "left")
    missing = F.lit(past) - F.coalesce(F.col("_held"), F.lit(0))
    status = (F.when(F.col("status") != "ok", F.col("status"))
              .when(F.coalesce(_bad_window(), F.lit(False)), "unusable_window")
              .when(~F.coalesce("_now", F.lit(False)), "no_observation")
              .when(missing > 0, "insufficient_history").otherwise("ok"))
    p = [F.col(f"_p{i}") for i in range(1, past + 1)]
    sums = (p[0], _sum_in_order(p[:max(1, past // 2)]), _sum_in_order(p))
    usable = F.col("status") == "ok"
    out = out.withColumn("missing_history", F.when(usable, missing)).withColumn("status", status)
    return out.select(
        "request_id", s.entity, "prediction_time", "threshold_mm", "status", "missing_history",
        F.hour("prediction_time").alias("hour"), F.month("prediction_time").alias("month"),
        *[F.when(usable, c).alias(n) for c, n in zip(sums, RAINFALL_FEATURES)],
        *([F.when(usable, F.col("history")).alias("history")] if with_history else []))


def verify(requests: DataFrame, obs: DataFrame, s: SeriesSpec, future: int = FUTURE_SLOTS) -> DataFrame:
    """Recorded outcome of each request: total of the next slots and strict exceedance.

    Null when the request was rejected, a slot is missing or the window is unusable.
    """
    facts = _slot_facts(_moments(requests, s), obs, s, range(1, future + 1))
    held = F.count_if(F.col("_n") > 0).alias("_held")
    found = _quality(facts, s, [held, *[_value(i).alias(f"_f{i}") for i in range(1, future + 1)]])
    complete = (F.col("_held") == future) & ~_bad_window()
    total = F.when(complete, _sum_in_order([F.col(f"_f{i}") for i in range(1, future + 1)]))
    out = requests.join(found, [s.entity, "prediction_time"], "left").withColumn("total_mm", total)
    return out.select("request_id", s.entity, "prediction_time", "threshold_mm", "status", "total_mm",
                      (F.col("total_mm") > F.col("threshold_mm")).alias("exceeded"))
