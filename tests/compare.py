"""Compare a Spark result with a DuckDB result, value by value."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

KINDS = {
    "tinyint": "int", "smallint": "int", "int": "int", "bigint": "int",
    "INTEGER": "int", "BIGINT": "int", "double": "double", "DOUBLE": "double",
    "string": "text", "VARCHAR": "text", "date": "date", "DATE": "date",
    "timestamp_ntz": "time", "timestamp": "time", "TIMESTAMP": "time", "boolean": "bool", "BOOLEAN": "bool",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def differences(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs: columns, kinds of type, or rows (as multisets)."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    types = [str(d[1]) for d in result.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    order = sorted(names)
    found = []
    for name in order:
        mine, theirs = dict(df.dtypes)[name], types[names.index(name)]
        if KINDS.get(mine, mine) != KINDS.get(theirs, theirs):
            found.append(f"type of {name}: {mine} against {theirs}")
    expected = Counter(tuple(_plain(row[names.index(n)]) for n in order) for row in result.fetchall())
    actual = Counter(tuple(_plain(row[n]) for n in order) for row in df.collect())
    missing, extra = expected - actual, actual - expected
    if missing or extra:
        found.append(f"{sum(missing.values())} missing, {sum(extra.values())} extra of {sum(expected.values())}")
        found += [f"missing {row}" for row in list(missing)[:3]] + [f"extra {row}" for row in list(extra)[:3]]
    return found
