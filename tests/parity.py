"""Runs a Spark query and its SQL side by side and compares names, types and every value."""

from __future__ import annotations

import datetime
import decimal
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"create view {name} as select * from '{path}'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, (str, int)):
        return value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.date().isoformat() if value.time() == datetime.time() else value.isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def _kind(value) -> str:
    return {bool: "bool", int: "int", float: "float", decimal.Decimal: "decimal"}.get(
        type(value), type(value).__name__
    )


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Differences found; empty when both sides agree exactly."""
    got = [tuple(row) for row in df.collect()]
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    want = cursor.fetchall()
    problems = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    if len(got) != len(want):
        return [f"rows {len(got)} != {len(want)}"]
    left, right = rows_of(df.columns, got), rows_of(names, want)
    different = [(a, b) for a, b in zip(left, right) if a != b]
    if different:
        problems.append(f"{len(different)} of {len(left)} rows differ, first {different[0]}")
    kinds_left = {name: {_kind(r[i]) for r in got if r[i] is not None} for i, name in enumerate(df.columns)}
    kinds_right = {name: {_kind(r[i]) for r in want if r[i] is not None} for i, name in enumerate(names)}
    for name, kinds in kinds_left.items():
        if kinds and kinds_right[name] and kinds != kinds_right[name]:
            problems.append(f"type of {name}: {kinds} != {kinds_right[name]}")
    return problems
