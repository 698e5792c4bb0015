"""Compare a registered query with its SQL in DuckDB, value by value."""

from __future__ import annotations

import decimal
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _norm(value):
    """The exact value together with its kind: 1 and 1.0 are not the same."""
    if isinstance(value, float) and math.isnan(value):
        return ("float", "nan")
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    return (type(value).__name__, value)


def rows_of(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return (
        [columns[i] for i in order],
        Counter(tuple(_norm(r[i]) for i in order) for r in rows),
    )


def compare(df, con, text: str) -> str | None:
    """None if equal, else what differs."""
    cursor = con.execute(text)
    want_cols, want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    got_cols, got = rows_of(df.columns, df.collect())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if sum(got.values()) != sum(want.values()):
        return f"{sum(got.values())} rows != {sum(want.values())}"
    if got != want:
        more, less = list((got - want).items())[:2], list((want - got).items())[:2]
        return f"{sum((got - want).values())} rows differ, e.g. spark {more} sql {less}"
    return None
