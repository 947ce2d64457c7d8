"""Compare a Spark result with a SQL result as multisets of rows."""

from __future__ import annotations

import datetime
import decimal
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return repr(float(value))
    if isinstance(value, float):
        return "None" if value != value else repr(value)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    return repr(value)


def rows(columns: list[str], data) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in data)


def difference(df, con, sql: str) -> str | None:
    """None when equal, else a short description."""
    relation = con.execute(sql)
    names = [d[0] for d in relation.description]
    if sorted(names) != sorted(df.columns):
        return f"columns differ: {sorted(set(names) ^ set(df.columns))}"
    want = rows(names, relation.fetchall())
    got = rows(df.columns, df.collect())
    if want == got:
        return None
    missing, extra = want - got, got - want
    return (
        f"{sum(got.values())} rows, expected {sum(want.values())}; {sorted(names)}\n"
        f" missing {sum(missing.values())}: {list(missing)[:2]}\n extra {sum(extra.values())}: {list(extra)[:2]}"
    )
