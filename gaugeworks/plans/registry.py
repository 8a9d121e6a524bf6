"""Registry of queries, and the SQL fragments their checks are composed of."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
FRAGMENTS: dict[str, tuple[tuple[str, ...], str]] = {}
DIGITS = 6


def fragment(name: str, sql: str, *needs: str) -> None:
    FRAGMENTS[name] = (needs, sql)


def compose(select: str, *needs: str) -> str:
    """Prefix a SELECT with the common table expressions it needs, dependencies first."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for n in FRAGMENTS[name][0]:
                visit(n)
            order.append(name)

    for n in needs:
        visit(n)
    if not order:
        return select
    return "WITH " + ",\n".join(f"{n} AS ({FRAGMENTS[n][1]})" for n in order) + "\n" + select


def query(name: str, sql: str | None = None, *needs: str) -> Callable[[Query], Query]:
    """Register a query, with the SQL that must give the same rows."""
    def register(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: rounded(fn(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = compose(sql, *needs)
        return fn

    return register


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to a fixed number of digits: sums may differ in the last bits between engines."""
    return df.select(*[F.round(f"`{f.name}`", DIGITS).alias(f.name) if isinstance(f.dataType, DoubleType)
                       else F.col(f"`{f.name}`") for f in df.schema.fields])
