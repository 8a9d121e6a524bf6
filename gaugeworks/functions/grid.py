"""Wall-clock epoch arithmetic on timestamp columns.

All arithmetic is on whole numbers. The epoch counts from a zone-free origin, so a
``timestamp_ntz`` column and a session-zone ``timestamp`` column that show the same wall
clock land in the same slot, and slots of a day start at midnight.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MICROS = 1_000_000
_ORIGIN = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def floor_div(a: Column, b: int) -> Column:
    """Whole-number division rounding down."""
    return F.call_function("div", a - F.pmod(a, F.lit(b)), F.lit(b))


def epoch_micros(ts: Column | str) -> Column:
    return F.timestamp_diff("MICROSECOND", F.expr(_ORIGIN), _col(ts))


def epoch_seconds(ts: Column | str) -> Column:
    """Whole seconds, rounding down."""
    return floor_div(epoch_micros(ts), MICROS)


def from_epoch_seconds(seconds: Column | str) -> Column:
    """The zone-free timestamp of a wall-clock epoch."""
    return F.timestamp_add("SECOND", _col(seconds), F.expr(_ORIGIN))


def nearest_slot(seconds: Column, slot_seconds: int) -> Column:
    """Epoch second of the nearest slot boundary; exactly halfway rounds up."""
    return floor_div(seconds * 2 + slot_seconds, 2 * slot_seconds) * slot_seconds


def off_grid(ts: Column | str, slot_seconds: int) -> Column:
    """True where a time is not a slot boundary, sub-second parts included."""
    return F.pmod(epoch_micros(ts), F.lit(slot_seconds * MICROS)) != 0


def slots_in_year(year: Column, slot_seconds: int) -> Column:
    days = F.datediff(F.make_date(year + 1, F.lit(1), F.lit(1)), F.make_date(year, F.lit(1), F.lit(1)))
    return F.call_function("div", days.cast("long") * 86_400, F.lit(slot_seconds))


def slots_in_month(year: Column, month: Column, slot_seconds: int) -> Column:
    days = F.day(F.last_day(F.make_date(year, month, F.lit(1))))
    return F.call_function("div", days.cast("long") * 86_400, F.lit(slot_seconds))
