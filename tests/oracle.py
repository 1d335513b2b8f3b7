"""Runs a registered query in Spark and its SQL in DuckDB and compares the rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return v


def rows(columns, data) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in data)


def compare(spark_df, con, sql: str) -> list[str]:
    """Differences between the two results, empty when they agree."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = rows(names, cursor.fetchall())
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns: sql {sorted(names)}, spark {sorted(spark_df.columns)}"]
    actual = rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    problems = []
    if sum(actual.values()) != sum(expected.values()):
        problems.append(f"rows: sql {sum(expected.values())}, spark {sum(actual.values())}")
    if expected - actual:
        problems.append(f"only in sql: {list((expected - actual).items())[:3]}")
    if actual - expected:
        problems.append(f"only in spark: {list((actual - expected).items())[:3]}")
    if not sum(expected.values()):
        problems.append("empty result: nothing was compared")
    return problems
