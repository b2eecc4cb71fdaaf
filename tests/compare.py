"""Runs a query on Spark and its SQL on DuckDB and compares rows, ignoring order."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb


def canonical(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day).isoformat()
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, (list, tuple)):
        return tuple(canonical(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, canonical(v)) for k, v in value.items()))
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def connect(folder: str):
    connection = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def sql_rows(connection, sql: str) -> tuple[list[str], Counter]:
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = Counter(tuple(canonical(r[i]) for i in order) for r in cursor.fetchall())
    return sorted(names), rows


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    rows = Counter(tuple(canonical(v) for v in r) for r in df.select(*names).toLocalIterator())
    return names, rows


def differences(expected: Counter, actual: Counter, show: int = 3) -> str:
    missing, extra = expected - actual, actual - expected
    return (
        f"{sum(expected.values())} expected, {sum(actual.values())} actual; "
        f"missing {sum(missing.values())}: {list(missing)[:show]}; "
        f"extra {sum(extra.values())}: {list(extra)[:show]}"
    )
