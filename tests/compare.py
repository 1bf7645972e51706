"""Compares a named query with its SQL, row by row and to the last digit."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(sf_dir: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return connection


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return repr(value)


def _canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(spark, connection, query, sql, sf_dir) -> str:
    """Empty when equal, else a short account of what differs."""
    df = query(spark, sf_dir)
    cursor = connection.execute(sql)
    names = [c[0] for c in cursor.description]
    expected = _canonical(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(set(df.columns) ^ set(names))}"
    found = _canonical(df.columns, [tuple(row) for row in df.collect()])
    if len(found) != len(expected):
        return f"{len(found)} rows, expected {len(expected)}"
    wrong = [(a, b) for a, b in zip(found, expected) if a != b]
    if not wrong:
        return ""
    a, b = wrong[0]
    cells = [(sorted(names)[i], x, y) for i, (x, y) in enumerate(zip(a, b)) if x != y]
    return f"{len(wrong)} of {len(found)} rows differ, first: {a[:4]} {cells[:4]}"
