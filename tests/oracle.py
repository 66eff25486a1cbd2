"""Side-by-side runs of registered queries and their DuckDB SQL."""

from __future__ import annotations

import math
import os

import duckdb


def normal(value):
    if isinstance(value, float):
        return round(value, 6) if math.isfinite(value) else str(value)
    if isinstance(value, (list, tuple)):
        return str([normal(v) for v in value])
    return value


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in os.listdir(folder):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{folder}/{name}'")
    return con


def same(con: duckdb.DuckDBPyConnection, frame, sql: str) -> None:
    """Equal columns, and equal rows in any order."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    columns = sorted(frame.columns)
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    key = lambda row: tuple(map(str, row))
    want = sorted((tuple(normal(row[i]) for i in at) for row in result.fetchall()), key=key)
    got = sorted((tuple(normal(row[c]) for c in columns) for row in frame.collect()), key=key)
    assert got == want
