"""Compare a query's result with its SQL on the same tables."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    found = duckdb.connect()
    for table in TABLES:
        found.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return found


def _rows(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def difference(df, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when column names and rows agree, else what does not."""
    found = connection.execute(sql)
    names = [column[0] for column in found.description]
    expected = _rows(names, found.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(names)}"
    got = _rows(df.columns, [tuple(row) for row in df.collect()])
    if len(got) != len(expected):
        return f"{len(got)} rows instead of {len(expected)}"
    for mine, theirs in zip(got, expected):
        if mine != theirs:
            return f"{mine} instead of {theirs}"
    return None
