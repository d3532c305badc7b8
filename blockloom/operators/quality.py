"""Data-quality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blockloom.operators.windows import next_value

# Logical keys of the raw tables.
RAW_KEYS = {
    "raw_blocks": ["chain_id", "block_number"],
    "raw_txs": ["chain_id", "hash"],
    "raw_traces": ["chain_id", "block_number", "transaction_index", "trace_address"],
    "raw_logs": ["chain_id", "transaction_hash", "log_index"],
}


def duplicate_report(df: DataFrame, keys: list[str], by: list[str] | None = None) -> DataFrame:
    """Distinct keys and keys that occur more than once (per ``by`` columns, which must be keys)."""
    counted = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    return counted.groupBy(*(by or [])).agg(F.count("*").alias("total"), F.count_if(F.col("_n") > 1).alias("duplicates"))


def ranges(df: DataFrame, n: str, keys: list[str], width: int = 1_000_000) -> DataFrame:
    """Contiguous runs of the whole numbers in ``n`` per key: range_start, range_end.

    Runs are found inside buckets of ``width`` numbers.  Only runs that touch a bucket border
    (at most two per bucket) meet in the second window, which joins them across borders.
    """
    size = F.lit(width).cast("bigint")
    number = F.col(n).cast("bigint")
    rows = df.select(*keys, number.alias("_n")).distinct()
    rows = rows.withColumn("_low", F.col("_n") - F.pmod(F.col("_n"), size))
    w = Window.partitionBy(*keys, "_low").orderBy("_n")
    runs = (
        rows.withColumn("_run", F.col("_n") - F.row_number().over(w))
        .groupBy(*keys, "_low", "_run")
        .agg(F.min("_n").alias("range_start"), F.max("_n").alias("range_end"))
    )
    touches = (F.col("range_start") == F.col("_low")) | (F.col("range_end") == F.col("_low") + size - 1)
    inside = runs.where(~touches).select(*keys, "range_start", "range_end")
    by_key = Window.partitionBy(*keys).orderBy("range_start")
    border = runs.where(touches).withColumn(
        "_starts", (F.coalesce(F.lag("range_end").over(by_key) + 1 != F.col("range_start"), F.lit(True))).cast("int")
    )
    border = (
        border.withColumn("_group", F.sum("_starts").over(by_key))
        .groupBy(*keys, "_group")
        .agg(F.min("range_start").alias("range_start"), F.max("range_end").alias("range_end"))
        .select(*keys, "range_start", "range_end")
    )
    return inside.unionByName(border)


def _expand(gaps: DataFrame, keys: list[str], out: str, chunk: int = 100_000) -> DataFrame:
    """Rows gap_start..gap_end to one row per number, in bounded pieces."""
    pieces = gaps.where("gap_end >= gap_start").withColumn(
        "_from", F.explode(F.sequence("gap_start", "gap_end", F.lit(chunk).cast("bigint")))
    )
    numbers = F.sequence("_from", F.least(F.col("gap_end"), F.col("_from") + chunk - 1))
    return pieces.select(*keys, F.explode(numbers).alias(out))


def missing_blocks(df: DataFrame, n: str = "block_number", keys: list[str] | None = None, width: int = 1_000_000) -> DataFrame:
    """Numbers absent between the lowest and the highest one of each key.

    Works from the gaps between stored runs, so present blocks are never compared with a full list.
    """
    keys = keys or []
    runs = next_value(ranges(df, n, keys, width), "range_start", "range_start", keys, "_next", width)
    gaps = runs.select(*keys, (F.col("range_end") + 1).alias("gap_start"), (F.col("_next") - 1).alias("gap_end"))
    return _expand(gaps, keys, n)


def missing_in_range(df: DataFrame, from_block: int, to_block: int, n: str = "block_number") -> DataFrame:
    """Numbers of one inclusive range that ``df`` does not hold."""
    spine = df.sparkSession.range(from_block, to_block + 1).withColumnRenamed("id", n)
    here = df.where(F.col(n).between(from_block, to_block))  # before the cast, so that it reaches the scan
    return spine.join(here.select(F.col(n).cast("bigint").alias(n)).distinct(), n, "left_anti")


def receipt_mismatch(blocks: DataFrame) -> DataFrame:
    """Nested blocks whose receipt count differs from their transaction count."""
    txs = F.coalesce(F.size("block.transactions"), F.lit(0))
    receipts = F.coalesce(F.size("receipts"), F.lit(0))
    # not a filter: that would be pushed down to the scan, which would make the arrays a second time, in the scan's few tasks
    counted = F.struct(F.col("block.number").alias("block_number"), txs.alias("txs"), receipts.alias("receipts"))
    return blocks.select(counted.alias("counted")).select(F.inline(F.when(F.col("counted.txs") != F.col("counted.receipts"), F.array("counted"))))


def max_block(df: DataFrame, by: list[str] | None = None, n: str = "block_number") -> DataFrame:
    return df.groupBy(*(by or [])).agg(F.max(n).alias("max_block"))
