"""Append-only tables whose newest version of a row counts, and other read-time merges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, keys: list[str], version: str, tie: list[str] | None = None) -> DataFrame:
    """The row with the greatest version per key; ``tie`` columns decide between equal versions.

    An aggregation instead of a ranking window: old versions are dropped map-side, so a key
    with very many versions does not gather in one task.
    """
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(version, *(tie or [])))
    return df.groupBy(*keys).agg(newest.alias("_row")).select(*[c if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def summed(df: DataFrame, keys: list[str], sums: list[str], maxes: list[str]) -> DataFrame:
    """Accumulator table at read time: sums added up, maxima kept."""
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums], *[F.max(c).alias(c) for c in maxes])


def upsert(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Append newer versions; readers use ``latest_by_key``, ``compact`` tidies up."""
    writer = df.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def compact(df: DataFrame, keys: list[str], version: str, target: str, tie: list[str] | None = None, partition_by: list[str] | None = None) -> None:
    """Write the newest versions to a new folder, which then replaces the old one in the catalog."""
    writer = latest_by_key(df, keys, version, tie).write.mode("errorifexists")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(target)


def since_last(df: DataFrame, target: DataFrame | None, col: str, keys: list[str] | None = None) -> DataFrame:
    """Rows beyond the greatest ``col`` already in ``target`` (per key if keys are given)."""
    if target is None:
        return df
    if not keys:
        top = target.agg(F.coalesce(F.max(col), F.lit(0)).alias("_top"))
        return df.where(F.col(col) > top.scalar())
    top = target.groupBy(*keys).agg(F.max(col).alias("_top"))
    return df.join(top, keys, "left").where(F.col("_top").isNull() | (F.col(col) > F.col("_top"))).drop("_top")


def only_new(df: DataFrame, target: DataFrame | None, keys: list[str]) -> DataFrame:
    """Rows whose key the target does not hold yet; keeps late, lower-numbered blocks that a maximum would drop."""
    return df if target is None else df.join(target.select(*keys), keys, "left_anti")


def overwrite_periods(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace exactly the partitions present in ``df``; running it twice gives the same table."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
