"""Runs a registered query and its SQL and compares the results."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _kind(name: str) -> str:
    """Type names of Spark and of the SQL engine, brought to one spelling."""
    name = str(name).lower().replace(" ", "")
    same = {"varchar": "string", "integer": "int", "timestamp": "timestamp_ntz"}
    return same.get(name, name)


def difference(spark, query, sql: str, sf_dir: str) -> str | None:
    """What differs between query and SQL: columns, types, row count or values."""
    df = query(spark, sf_dir)
    result = oracle(sf_dir).execute(sql)
    expected_types = {d[0]: _kind(d[1]) for d in result.description}
    types = {f.name: _kind(f.dataType.simpleString()) for f in df.schema}
    if types != expected_types:
        return f"schema {sorted(types.items())} instead of {sorted(expected_types.items())}"
    columns = sorted(types)
    place = [d[0] for d in result.description]
    expected = sorted(
        (tuple(row[place.index(c)] for c in columns) for row in result.fetchall()), key=repr
    )
    found = sorted((tuple(row[c] for c in columns) for row in df.collect()), key=repr)
    if len(found) != len(expected):
        return f"{len(found)} rows instead of {len(expected)}"
    wrong = [pair for pair in zip(found, expected, strict=True) if pair[0] != pair[1]]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None
