"""Row-by-row comparison of a registered query with its SQL twin."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    return v


def _key(row):
    return tuple((v is None, str(type(v).__name__), str(v)) for v in row)


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, [tuple(_norm(v) for v in r) for r in df.select(*[f"`{c}`" for c in cols]).collect()]


def duck_rows(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], [tuple(_norm(r[i]) for i in order) for r in cur.fetchall()]


def differences(df, con, sql, limit: int = 3) -> list[str]:
    c1, r1 = spark_rows(df)
    c2, r2 = duck_rows(con, sql)
    if c1 != c2:
        return [f"columns {sorted(set(c1) ^ set(c2))}"]
    if len(r1) != len(r2):
        return [f"rows {len(r1)} != {len(r2)}", str(r1[:2]), str(r2[:2])]
    out = []
    for a, b in zip(sorted(r1, key=_key), sorted(r2, key=_key)):
        bad = [(c, x, y) for c, x, y in zip(c1, a, b) if x != y or type(x) is not type(y)]
        if bad:
            out.append(str(bad))
            if len(out) >= limit:
                break
    return out
