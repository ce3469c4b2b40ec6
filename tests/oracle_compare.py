"""Compare a query with its SQL: same columns, same rows in any order."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """DuckDB with the given tables as views."""
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    return str(value)


def _rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(record[i]) for i in order) for record in records)


def differences(df, con, sql: str) -> list[str]:
    """What differs between the two results, empty when nothing does."""
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    expected = _rows(columns, result.fetchall())
    actual = _rows(df.columns, df.collect())
    if sorted(columns) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(columns)}"]
    if len(actual) != len(expected):
        return [f"{len(actual)} rows != {len(expected)}"]
    return [f"{a} != {e}" for a, e in zip(actual, expected) if a != e][:3]
