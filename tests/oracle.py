"""Compare a query with its SQL, row by row."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf: str):
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    return v


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in data)


def compare(df, con, sql: str) -> str | None:
    """None when equal, else a short account of the difference."""
    result = con.execute(sql)
    sql_names = [d[0] for d in result.description]
    expected = rows(sql_names, result.fetchall())
    if sorted(df.columns) != sorted(sql_names):
        return f"columns {sorted(df.columns)} != {sorted(sql_names)}"
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    if got == expected:
        return None
    missing, extra = expected - got, got - expected
    return (
        f"{sum(got.values())} rows vs {sum(expected.values())}; "
        f"missing {sum(missing.values())} e.g. {str(list(missing)[:2])[:600]}; "
        f"extra {sum(extra.values())} e.g. {str(list(extra)[:2])[:600]}"
    )
