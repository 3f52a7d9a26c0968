"""Row-for-row comparison of a Spark result with a DuckDB query."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from pathlib import Path

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, float):
        return repr(value)
    return value


def spark_rows(df):
    names = sorted(df.columns)
    rows = df.select(*[f"`{n}`" for n in names]).collect()
    return names, Counter(tuple(plain(v) for v in row) for row in rows)


def duckdb_rows(con, sql):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = Counter(tuple(plain(row[i]) for i in order) for row in result.fetchall())
    return sorted(names), rows


def difference(df, con, sql) -> str | None:
    """None when both agree, else a short account of what differs."""
    left_names, left = spark_rows(df)
    right_names, right = duckdb_rows(con, sql)
    if left_names != right_names:
        return f"columns differ: {left_names} and {right_names}"
    if left == right:
        return None
    only_left, only_right = left - right, right - left
    return (
        f"{sum(left.values())} and {sum(right.values())} rows; only in Spark "
        f"{list(only_left.items())[:2]}; only in DuckDB {list(only_right.items())[:2]}"
    )
