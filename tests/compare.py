"""Compare a Spark result with a DuckDB result, column by column and row by row."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def duck(sf_dir: str):
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def multiset(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def assert_same(spark_df, duck_result) -> int:
    columns = [d[0] for d in duck_result.description]
    expected = multiset(columns, duck_result.fetchall())
    assert sorted(spark_df.columns) == sorted(columns)
    found = multiset(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    missing, extra = expected - found, found - expected
    assert not missing and not extra, f"missing {list(missing)[:3]}, extra {list(extra)[:3]}"
    return sum(found.values())
