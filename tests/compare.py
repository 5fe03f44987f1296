"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        return format(value.normalize(), "f")
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def difference(spark_df, con, sql: str) -> str | None:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = bag(names, result.fetchall())
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} against {sorted(names)}"
    found = bag(spark_df.columns, spark_df.collect())
    if found == expected:
        return None
    return (f"{sum(found.values())} rows against {sum(expected.values())}; only here "
            f"{list((found - expected).items())[:2]}; only there {list((expected - found).items())[:2]}")
