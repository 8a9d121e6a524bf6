"""Predicates and guarded arithmetic on measured values."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, functions as F

INF = float("inf")


def non_finite(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.isnan(c) | (F.abs(c) == F.lit(INF))


def bad_measure(c: str) -> Column:
    """Null, NaN, infinite or negative. NaN is tested first: it compares as largest."""
    return F.col(c).isNull() | non_finite(c) | (F.col(c) < 0)


def bad_angle(c: str, limit: float) -> Column:
    return F.col(c).isNull() | non_finite(c) | ~F.col(c).between(-limit, limit)


def blank(c: str) -> Column:
    return F.col(c).isNull() | (F.trim(F.col(c)) == "")


def any_of(rules: Iterable[Column]) -> Column:
    """True when some rule is true; a rule that is unknown counts as not broken."""
    return reduce(lambda a, b: a | b, [F.coalesce(r, F.lit(False)) for r in rules])


def ratio(a: Column, b: Column) -> Column:
    """Double division, null when the denominator is zero or null."""
    return F.try_divide(a.cast("double"), b.cast("double"))
