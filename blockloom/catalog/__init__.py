"""Registered queries: each runs over the whole test tables and, where SQL can say it, has a DuckDB equivalent."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blockloom.functions.text import TIME_PATTERN
from blockloom.session import prepare
from blockloom.sources.star_schema import Star


@dataclass(frozen=True)
class Query:
    name: str
    ids: str  # operators of the inventory it covers
    run: Callable[[Star], DataFrame]
    sql: str | None


CATALOG: dict[str, Query] = {}


def query(name: str, ids: str, sql: str | None = None):
    """Register a function of the test tables under ``name``."""

    def add(run: Callable[[Star], DataFrame]):
        if name in CATALOG:
            raise ValueError(f"query {name} is registered twice")
        CATALOG[name] = Query(name, ids, run, sql)
        return run

    return add


def plain(df: DataFrame) -> DataFrame:
    """Result columns in types that compare across engines.

    Times become text, exact decimals become text, addresses and hashes (bytes) the number in
    their last eight bytes.
    """
    out = []
    for field in df.schema.fields:
        c, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, TIME_PATTERN)
        elif isinstance(kind, T.DecimalType):
            c = c.cast("string")
        elif isinstance(kind, T.BinaryType):
            c = F.conv(F.hex(F.substring(c, -8, 8)), 16, 10).cast("bigint")
        elif isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(kind, T.FloatType):
            c = c.cast("double")
        out.append(c.alias(field.name))
    return df.select(*out)


def exact(df: DataFrame) -> DataFrame:
    """As ``plain``, with nothing cut: bytes as their hex text, lists of bytes joined by commas, times to the millisecond."""
    out = []
    for field in df.schema.fields:
        c, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.TimestampType):
            c = F.date_format(c, TIME_PATTERN + ".SSS")
        elif isinstance(kind, T.BinaryType):
            c = F.lower(F.hex(c))
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.BinaryType):
            c = F.array_join(F.transform(c, lambda x: F.lower(F.hex(x))), ",")
        out.append(c.alias(field.name))
    return plain(df.select(*out))


def load() -> dict[str, Query]:
    from blockloom.catalog import balances, chain, metrics, platform, relational, streams, whole  # noqa: F401

    return CATALOG


def runner(q: Query) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return q.run(Star(prepare(spark), folder))

    run.__name__ = q.name
    run.__doc__ = f"{q.ids}"
    return run


# --- SQL fragments ------------------------------------------------------------------------


def period_sql(ts: str, granularity: str) -> str:
    if granularity == "week":
        return f"(date_trunc('week', {ts} + INTERVAL 1 DAY) - INTERVAL 1 DAY)"
    return f"date_trunc('{granularity}', {ts})"


def text_time(expr: str, pattern: str = "%Y-%m-%d %H:%M:%S") -> str:
    return f"strftime({expr}, '{pattern}')"
