"""Runs a query and its SQL on the same tables and compares them, columns by name, rows in any order."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(map(_plain, v))
    return v


def rows_of(names: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty when equal."""
    a_names, a = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    b_names, b = rows_of([d[0] for d in cur.description], cur.fetchall())
    if a_names != b_names:
        return f"columns {a_names} and {b_names}"
    if a != b:
        return f"{sum(a.values())} and {sum(b.values())} rows; only in the first: {list((a - b).items())[:3]}; only in the second: {list((b - a).items())[:3]}"
    return ""
