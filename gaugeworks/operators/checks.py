"""Counting rule failures in one pass and turning the counts into issues."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def rule_counts(df: DataFrame, rules: Mapping[str, Column], by: Sequence[str] = (),
                extra: Sequence[Column] = ()) -> DataFrame:
    """One aggregate row per group with the number of rows that break each rule."""
    counted = [F.count_if(rule).alias(name) for name, rule in rules.items()]
    return df.groupBy(*by).agg(*extra, *counted)


def issues(counts: DataFrame, names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Long form of the non-zero counts: group columns, ``issue``, ``failures``."""
    return (counts.select(*by, *[F.col(n).cast("long").alias(n) for n in names])
            .unpivot(list(by), list(names), "issue", "failures")
            .where(F.col("failures") > 0))


def require_empty(df: DataFrame, message: str) -> None:
    """Raise when a violations table has a row. This runs a job."""
    if not df.isEmpty():
        raise ValueError(message)


def require_none(df: DataFrame, rules: Mapping[str, Column], message: str) -> None:
    """Check all rules in one scan and raise with the names of the broken ones."""
    row = rule_counts(df, rules).first()
    broken = {n: row[n] for n in rules if row[n]}
    if broken:
        raise ValueError(f"{message}: {broken}")
