"""Aggregations. Every one combines map-side before its shuffle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockloom.functions.periods import period_start


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sum_if(c, condition: Column) -> Column:
    c = _col(c)
    return F.coalesce(F.sum(F.when(condition, c)), F.lit(0))


def count_if(condition: Column) -> Column:
    return F.count_if(condition)


def distinct_count(*cols, approx: bool = False) -> Column:
    """Exact distinct count of one column or of a tuple of columns, or its HyperLogLog estimate."""
    if approx:
        return F.approx_count_distinct(_col(cols[0]) if len(cols) == 1 else F.struct(*[_col(c) for c in cols]))
    return F.count_distinct(*[_col(c) for c in cols])


def any_of(c, order) -> Column:
    """One value of the group; deterministic, the one with the greatest ``order``."""
    return F.max_by(_col(c), _col(order))


def distinct(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*cols).distinct()


def agg_of_agg(df: DataFrame, outer: list[str], inner: list, first: list[Column], second: list[Column]) -> DataFrame:
    """Aggregate by outer + inner keys, then the result by the outer keys."""
    return df.groupBy(*outer, *inner).agg(*first).groupBy(*outer).agg(*second)


def count_by(df: DataFrame, keys: list, name: str = "count") -> DataFrame:
    """Rows per key; keys may be arrays."""
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def count_by_period(df: DataFrame, granularity: str, extra_keys: list[str], ts: str = "block_time") -> DataFrame:
    return df.groupBy(*extra_keys, period_start(ts, granularity).alias("period")).agg(F.count("*").alias("count"))


def totals(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.agg(*[F.sum(c).alias(f"total_{c}") for c in cols])


def ratio(a, b) -> Column:
    """a / b as double, 0 where b is 0."""
    a, b = _col(a).cast("double"), _col(b).cast("double")
    return F.when(b == 0, 0.0).otherwise(a / F.nullif(b, F.lit(0.0)))


def scalars(**frames: DataFrame) -> DataFrame:
    """One row from several one-value DataFrames, as a union folded by one aggregation (no cross join)."""
    rows = [f.select(F.lit(name).alias("_name"), F.col(f.columns[0]).alias("_value")) for name, f in frames.items()]
    merged = reduce(DataFrame.unionByName, rows)
    return merged.agg(*[F.max(F.when(F.col("_name") == name, F.col("_value"))).alias(name) for name in frames])
