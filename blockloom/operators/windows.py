"""Ordered operators over keyed series.

A plain window sorts all rows of a key in one task, which is fine for series with one row
per period.  For raw-size series pass ``width``: rows are cut into buckets of the order
column, each (key, bucket) is a window of its own, and what a bucket needs from its
neighbours travels through a table with one row per bucket.  So a key that holds a third
of all rows is still spread over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def order_number(df: DataFrame, order: str) -> Column:
    """Order column as a number: timestamps in microseconds."""
    if isinstance(df.schema[order].dataType, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(order).cast("timestamp"))
    return F.col(order).cast("bigint")


def _width(df: DataFrame, order: str, width: int) -> int:
    """Bucket width in units of ``order_number``; for timestamps it is given in seconds."""
    is_time = isinstance(df.schema[order].dataType, (T.TimestampType, T.TimestampNTZType))
    return width * 1_000_000 if is_time else width


def _bucketed(df: DataFrame, order: str, width: int) -> DataFrame:
    size = F.lit(_width(df, order, width)).cast("bigint")
    number = order_number(df, order)
    return df.withColumn("_bucket", F.call_function("div", number - F.pmod(number, size), size))


def _with_neighbour(inner: DataFrame, summary: DataFrame, keys: list[str]) -> DataFrame:
    condition = inner["_bucket"] == summary["_bucket"]
    for k in keys:
        condition = condition & inner[k].eqNullSafe(summary[k])
    picked = [summary[c] for c in summary.columns if c not in keys and c != "_bucket"]
    return inner.join(summary, condition, "left").select(*[inner[c] for c in inner.columns], *picked)


def running_sum(
    df: DataFrame, value: str, order: str, keys: list[str], out: str = "running", width: int | None = None, then: list[str] | None = None
) -> DataFrame:
    """Sum of ``value`` from the first row of the key to this one, in (order, then) order."""
    if width is None:
        w = Window.partitionBy(*keys).orderBy(order, *(then or [])).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumn(out, F.sum(value).over(w))
    rows = _bucketed(df, order, width)
    w = (
        Window.partitionBy(*keys, "_bucket")
        .orderBy(order, *(then or []))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    summary = (
        rows.groupBy(*keys, "_bucket").agg(F.sum(value).alias("_sum")).select(*keys, "_bucket", F.sum("_sum").over(before).alias("_before"))
    )
    inner = rows.withColumn("_inside", F.sum(value).over(w))
    total = F.when(F.col("_inside").isNull() & F.col("_before").isNull(), F.lit(None)).otherwise(
        F.coalesce("_inside", F.lit(0)) + F.coalesce("_before", F.lit(0))
    )
    return _with_neighbour(inner, summary, keys).withColumn(out, total).drop("_bucket", "_inside", "_before")


def first_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key in ``order``; an aggregation, so hot keys combine map-side."""
    rest = [c for c in df.columns if c not in keys]
    ordering = F.struct(*order)
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), ordering).alias("_row")).select(*keys, "_row.*")


def next_value(df: DataFrame, col: str, order: str, keys: list[str], out: str = "next_value", width: int | None = None) -> DataFrame:
    """``col`` of the following row of the key, NULL for the last one."""
    if width is None:
        return df.withColumn(out, F.lead(col).over(Window.partitionBy(*keys).orderBy(order)))
    rows = _bucketed(df, order, width)
    inner = rows.withColumn("_is_last", F.row_number().over(Window.partitionBy(*keys, "_bucket").orderBy(F.desc(order), F.desc(col))) == 1)
    inner = inner.withColumn("_inside", F.lead(col).over(Window.partitionBy(*keys, "_bucket").orderBy(order, col)))
    firsts = rows.groupBy(*keys, "_bucket").agg(F.min_by(col, F.struct(order, col)).alias("_first"))
    summary = firsts.select(
        *keys, "_bucket", F.lead("_first").over(Window.partitionBy(*keys).orderBy("_bucket")).alias("_following")
    )
    value = F.when(F.col("_is_last"), F.col("_following")).otherwise(F.col("_inside"))
    return _with_neighbour(inner, summary, keys).withColumn(out, value).drop("_bucket", "_inside", "_is_last", "_following")


def previous_event(df: DataFrame, keys: list[str], ts: str, out: str = "previous", width: int | None = None) -> DataFrame:
    """The greatest ``ts`` of the key that is strictly before this row's ``ts``."""
    kind = df.schema[ts].dataType
    back = (lambda c: F.timestamp_micros(c)) if isinstance(kind, T.TimestampType) else (lambda c: c.cast(kind))
    if width is None:
        rows = df.withColumn("_order", order_number(df, ts))
        w = Window.partitionBy(*keys).orderBy("_order").rangeBetween(Window.unboundedPreceding, -1)
        return rows.withColumn(out, back(F.max("_order").over(w))).drop("_order")
    rows = _bucketed(df, ts, width).withColumn("_order", order_number(df, ts))
    w = Window.partitionBy(*keys, "_bucket").orderBy("_order").rangeBetween(Window.unboundedPreceding, -1)
    inner = rows.withColumn("_inside", F.max("_order").over(w))
    summary = (
        rows.groupBy(*keys, "_bucket")
        .agg(F.max("_order").alias("_last"))
        .select(*keys, "_bucket", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_bucket")).alias("_earlier"))
    )
    return (
        _with_neighbour(inner, summary, keys)
        .withColumn(out, back(F.coalesce("_inside", "_earlier")))
        .drop("_bucket", "_inside", "_earlier", "_order")
    )


def last_known(
    df: DataFrame, col: str, order: str, keys: list[str], n: int = 100, out: str = "last_known", width: int | None = None
) -> DataFrame:
    """Last non-NULL ``col`` of the key among rows whose ``order`` is at most ``n`` lower.

    With ``width`` (at least ``n``) rows that hold a value also go, as carriers, to the next
    bucket, so every bucket can be answered alone.
    """
    if width is None:
        w = Window.partitionBy(*keys).orderBy(order).rangeBetween(-n, Window.currentRow)
        return df.withColumn(out, F.last(col, ignorenulls=True).over(w))
    if width < n:
        raise ValueError("width must be at least n")
    rows = _bucketed(df, order, width)
    size = F.lit(width).cast("bigint")
    place = F.col(order).cast("bigint")
    near_end = F.col(col).isNotNull() & (F.pmod(place, size) >= width - n)
    copies = F.when(near_end, F.array(F.struct(F.col("_bucket").alias("b"), F.lit(True).alias("own")), F.struct((F.col("_bucket") + 1).alias("b"), F.lit(False).alias("own")))).otherwise(
        F.array(F.struct(F.col("_bucket").alias("b"), F.lit(True).alias("own")))
    )
    spread = rows.withColumn("_copy", F.explode(copies))
    w = Window.partitionBy(*keys, F.col("_copy.b")).orderBy(order).rangeBetween(-n, Window.currentRow)
    return spread.withColumn(out, F.last(col, ignorenulls=True).over(w)).where("_copy.own").drop("_copy", "_bucket")
