"""The flagship plan: raw readings to exceedance rates per station and threshold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gaugeworks.operators import clean, features
from gaugeworks.plans import bindings as b
from gaugeworks.plans.registry import query
from gaugeworks.spec import SeriesSpec


def exceedance_by_station(spark: SparkSession, sf_dir: str, s: SeriesSpec = b.HOUR) -> DataFrame:
    """Align, keep the best reading per slot, build windows, label at every threshold, and rate."""
    kept = clean.dedupe_best(b.event_slots(spark, sf_dir, s), s, ["event_id"])
    labelled = features.expand_thresholds(features.slot_features(kept, s), b.LABELS)
    return labelled.groupBy(s.entity, "threshold_mm").agg(
        F.count("*").alias("samples"), F.sum("label").alias("positives"), F.avg("label").alias("exceedance_rate"))


def _sums(fn: str, n: int) -> str:
    return " + ".join(f"{fn}(rainfall, {i}) OVER w" for i in range(1, n + 1))


@query("flagship_exceedance", f"""SELECT station_id, threshold_mm, count(*) AS samples,
CAST(count(*) FILTER (future > threshold_mm) AS DOUBLE) AS positives,
round(count(*) FILTER (future > threshold_mm) / count(*), 6) AS exceedance_rate
FROM (SELECT station_id, "timestamp" AS t, {_sums('lead', 6)} AS future, lag("timestamp", 12) OVER w AS first_time,
    lead("timestamp", 6) OVER w AS last_time FROM (
    SELECT *, row_number() OVER (PARTITION BY station_id, aligned_epoch ORDER BY abs(shift_seconds), observation_time,
      event_id) AS rn FROM event_slots) WHERE rn = 1 WINDOW w AS (PARTITION BY station_id ORDER BY "timestamp")),
  (SELECT unnest({list(b.LABELS)})::DOUBLE AS threshold_mm)
WHERE first_time = t - INTERVAL 12 HOUR AND last_time = t + INTERVAL 6 HOUR GROUP BY ALL""", "event_slots")
def _(spark, sf):
    return exceedance_by_station(spark, sf)
