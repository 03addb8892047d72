"""Order-free comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime
import math
import os
from decimal import Decimal
from typing import Any

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return con


def _plain(v: Any) -> Any:
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v + 0.0)
    if isinstance(v, bool):
        return repr(v)
    if isinstance(v, int):
        return repr(v)
    if isinstance(v, Decimal):
        return f"decimal {v}"
    if isinstance(v, datetime.datetime):
        return f"ts {v.isoformat()}"
    return f"{type(v).__name__} {v}"


def canonical(columns: list[str], data: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in data)


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = result.fetchall()
    ours = [tuple(r) for r in spark_df.collect()]
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} != {sorted(names)}"]
    if len(ours) != len(theirs):
        return [f"rows {len(ours)} != {len(theirs)}"]
    a, b = canonical(spark_df.columns, ours), canonical(names, theirs)
    return [f"{x} != {y}" for x, y in zip(a, b) if x != y][:3]
