"""Compare a query's rows with those of its SQL check, whatever their order."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, bytearray):
        return bytes(value)
    return value


def _normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda index: columns[index])
    normal = [tuple(_plain(row[index]) for index in order) for row in rows]
    return sorted(normal, key=repr)


def assert_same(frame, connection: duckdb.DuckDBPyConnection, sql: str) -> int:
    """Raise unless names, rows and values agree exactly; returns the row count."""
    relation = connection.sql(sql)
    assert sorted(frame.columns) == sorted(relation.columns), (frame.columns, relation.columns)
    ours = _normal([tuple(row) for row in frame.collect()], frame.columns)
    theirs = _normal(relation.fetchall(), relation.columns)
    assert len(ours) == len(theirs), f"{len(ours)} rows, expected {len(theirs)}"
    for mine, expected in zip(ours, theirs, strict=True):
        assert mine == expected, f"{mine}\n!=\n{expected}"
    return len(ours)
