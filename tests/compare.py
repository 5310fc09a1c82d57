"""Runs queries and their SQL side by side."""

from __future__ import annotations

import math
import re
from collections.abc import Iterable
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = "region nation customer supplier part orders lineitem events".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{Path(sf_dir) / name}.parquet'")
    return con


def _cell(value: object) -> str:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def _rows(columns: list[str], rows: Iterable[tuple]) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return [tuple(_cell(row[i]) for i in order) for row in rows]


def is_ordered(sql: str) -> bool:
    """Whether the outermost query says how its rows are ordered."""
    depth, outside = 0, []
    for part in re.split(r"([()])", sql):
        depth += {"(": 1, ")": -1}.get(part, 0)
        if depth == 0:
            outside.append(part)
    return "ORDER BY" in " ".join(outside).upper()


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between a query's rows and its SQL's: nothing if the list is empty.

    Rows are compared in order where the SQL has one.
    """
    result = con.execute(sql)
    names = [column[0] for column in result.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    ours = _rows(df.columns, map(tuple, df.collect()))
    theirs = _rows(names, result.fetchall())
    if not is_ordered(sql):
        ours, theirs = sorted(ours), sorted(theirs)
    if len(ours) != len(theirs):
        return [f"{len(ours)} rows != {len(theirs)}"]
    return [f"{a} != {b}" for a, b in zip(ours, theirs, strict=True) if a != b]
