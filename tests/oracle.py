"""Compares a catalog query with its SQL on another engine, row by row."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd

TABLES = ["nation", "lineitem", "orders"]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{Path(sf_dir) / name}.parquet'")
    return connection


def _text(value) -> str:
    if value is None or (isinstance(value, float) and value != value) or value is pd.NaT:
        return "~"
    return repr(float(value)) if isinstance(value, float) else str(value)


def row_texts(columns: list[str], rows: list) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted("|".join(_text(row[i]) for i in order) for row in rows)


def compare(spark, sf_dir: str, connection, query, sql: str) -> list[str]:
    """Differences, as text; empty when names, types and rows agree."""
    df = query(spark, sf_dir)
    cursor = connection.execute(sql)
    names = [entry[0] for entry in cursor.description]
    kinds = {entry[0]: str(entry[1]) for entry in cursor.description}
    expected = cursor.fetchall()
    problems = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    same = {
        "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR", "boolean": "BOOLEAN",
    }
    for name, kind in df.dtypes:
        if same.get(kind, kind) != kinds[name]:
            problems.append(f"type of {name}: {kind} against {kinds[name]}")
    got, want = row_texts(df.columns, df.collect()), row_texts(names, expected)
    if len(got) != len(want):
        problems.append(f"{len(got)} rows against {len(want)}")
    if not want:
        problems.append("no rows")
    extra, missing = sorted(set(got) - set(want))[:2], sorted(set(want) - set(got))[:2]
    if got != want:
        problems.append(f"only here: {extra}; only there: {missing}")
    return problems
