"""Row-by-row comparison of a Spark result with DuckDB's on the same tables."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

KINDS = {
    "bigint": "long",
    "int": "int",
    "integer": "int",
    "hugeint": "huge",
    "double": "double",
    "string": "text",
    "varchar": "text",
    "boolean": "bool",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def _rows(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> list[str]:
    """What differs between the Spark frame and the SQL result; empty when nothing does."""
    result = con.execute(sql)
    kinds = {d[0]: KINDS.get(str(d[1]).lower(), str(d[1]).lower()) for d in result.description}
    names = [d[0] for d in result.description]
    expected = _rows(names, result.fetchall())
    found_kinds = {c: KINDS.get(t, t) for c, t in df.dtypes}
    found = _rows(df.columns, [tuple(r) for r in df.collect()])
    problems = []
    if found_kinds != kinds:
        pairs = {
            c: (found_kinds.get(c), kinds.get(c))
            for c in found_kinds.keys() | kinds.keys()
            if found_kinds.get(c) != kinds.get(c)
        }
        problems.append(f"columns differ (spark, sql): {pairs}")
    if found != expected:
        problems.append(
            f"{sum(found.values())} vs {sum(expected.values())} rows; "
            f"only spark {sum((found - expected).values())} {list((found - expected))[:2]}; "
            f"only sql {sum((expected - found).values())} {list((expected - found))[:2]}"
        )
    return problems
