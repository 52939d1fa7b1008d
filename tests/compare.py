"""Run a query in Spark and its SQL in DuckDB, and compare the rows as multisets."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def as_multiset(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def spark_rows(df):
    return df.columns, [tuple(r) for r in df.collect()]


def sql_rows(connection, sql: str):
    cursor = connection.execute(sql)
    return [d[0] for d in cursor.description], cursor.fetchall()


def differences(df, connection, sql: str) -> str | None:
    """None when equal, otherwise a short account."""
    got_columns, got = spark_rows(df)
    want_columns, want = sql_rows(connection, sql)
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {sorted(got_columns)} != {sorted(want_columns)}"
    left, right = as_multiset(got_columns, got), as_multiset(want_columns, want)
    if left == right:
        return None
    extra, lacking = list((left - right).items())[:3], list((right - left).items())[:3]
    return f"{len(got)} rows, expected {len(want)}; extra {extra}; lacking {lacking}"
