"""Row filters. All compile to predicates that reach the Parquet scan where the column allows it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockloom.constants import CREATE_CALLS
from blockloom.functions.hexes import from_hex, non_zero as non_zero_col


def for_chain(df: DataFrame, chain_id: int | None, col: str = "chain_id") -> DataFrame:
    """Rows of one chain (a partition column of the raw tables); None keeps every chain."""
    return df if chain_id is None else df.where(F.col(col) == chain_id)


# Partition column of stored raw tables: the day of block_time.
DAY = "block_date"


def in_time_range(df: DataFrame, ts: str = "block_time", first=None, last=None) -> DataFrame:
    """Half-open range [first, last); tables partitioned by day are pruned to its days."""
    by_day = DAY in df.columns and ts == "block_time"
    if first is not None:
        first = (first if isinstance(first, Column) else F.lit(first)).cast("timestamp")
        df = df.where(F.col(ts) >= first)
        df = df.where(F.col(DAY) >= F.to_date(first)) if by_day else df
    if last is not None:
        last = (last if isinstance(last, Column) else F.lit(last)).cast("timestamp")
        df = df.where(F.col(ts) < last)
        df = df.where(F.col(DAY) <= F.to_date(last)) if by_day else df
    return df


def in_block_range(df: DataFrame, from_block=None, to_block=None, col: str = "block_number") -> DataFrame:
    """Inclusive block range."""
    if from_block is not None:
        df = df.where(F.col(col) >= from_block)
    if to_block is not None:
        df = df.where(F.col(col) <= to_block)
    return df


def bytes_in(c, values: list[str]) -> Column:
    """Binary column equal to one of the hex literals."""
    c = F.col(c) if isinstance(c, str) else c
    return c == from_hex(values[0]) if len(values) == 1 else c.isin([bytes.fromhex(v) for v in values])


def with_signature(logs: DataFrame, signatures: list[str], col: str = "topic0") -> DataFrame:
    return logs.where(bytes_in(col, signatures))


def non_zero(df: DataFrame, col: str) -> DataFrame:
    return df.where(non_zero_col(col))


def creates(traces: DataFrame) -> DataFrame:
    """Contract creations inside successful transactions."""
    return traces.where(F.col("call_type").isin(*CREATE_CALLS) & F.col("tx_success"))


def has_length(df: DataFrame, col: str, n: int, op: str = "=") -> DataFrame:
    size = F.length(F.col(col))
    return df.where({"=": size == n, ">": size > n}[op])


def since(df: DataFrame, ts: str, interval: str, as_of) -> DataFrame:
    """Rows not older than ``interval`` (for example '7 DAY') before ``as_of``."""
    as_of = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    return in_time_range(df, ts, as_of - F.expr(f"INTERVAL {interval}"))


def having(grouped: DataFrame, condition: Column) -> DataFrame:
    return grouped.where(condition)


def search(df: DataFrame, cols: list[str], text: str) -> DataFrame:
    """Case-insensitive substring match in any of the columns."""
    needle = text.lower()
    return df.where(reduce(lambda a, b: a | b, [F.coalesce(F.lower(c).contains(needle), F.lit(False)) for c in cols]))


def find_one(df: DataFrame, key: str, value) -> DataFrame:
    return df.where(F.col(key) == value).limit(1)


def valid_ids(df: DataFrame, cols: list[str], pattern: str = "^[1-9A-HJ-NP-Za-km-z]+$") -> tuple[DataFrame, DataFrame]:
    """(rows whose ids match the base-58 alphabet, rejected rows)."""
    ok = reduce(lambda a, b: a & b, [F.coalesce(F.col(c).rlike(pattern), F.lit(False)) for c in cols])
    return df.where(ok), df.where(~ok)
