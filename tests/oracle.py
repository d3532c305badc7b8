"""Run a registered query in Spark and its SQL in DuckDB and compare whole results."""

from __future__ import annotations

import glob
import math
import os

import duckdb

_CONNECTIONS: dict[str, duckdb.DuckDBPyConnection] = {}


def connection(folder: str):
    if folder not in _CONNECTIONS:
        con = duckdb.connect()
        for path in glob.glob(f"{folder}/*.parquet"):
            con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
        _CONNECTIONS[folder] = con
    return _CONNECTIONS[folder]


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def compare(spark_df, sql: str, folder: str) -> str | None:
    """None if equal, else what differs."""
    cursor = connection(folder).execute(sql)
    columns = [d[0] for d in cursor.description]
    expected = normal(columns, cursor.fetchall())
    if sorted(spark_df.columns) != sorted(columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(columns)}"
    got = normal(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if len(got) != len(expected):
        return f"{len(got)} rows, expected {len(expected)}; first got {got[:2]}, expected {expected[:2]}"
    if got != expected:
        bad = [(g, e) for g, e in zip(got, expected) if g != e]
        return f"{len(bad)} of {len(got)} rows differ, first: got {bad[0][0]}, expected {bad[0][1]}"
    kinds = [{type(v) for r in rows for v in r} for rows in (got, expected)]
    if kinds[0] != kinds[1]:
        return f"value types {kinds[0]} != {kinds[1]}"
    return None
