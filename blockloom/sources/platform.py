"""Platform-chain inputs: blocks with JSON transactions, validator snapshots, the chain registry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blockloom import schemas
from blockloom.functions.text import json_field, tx_type_name, to_uint_or_zero
from blockloom.operators.normalize import fill_block_time
from blockloom.sources.blocks import JSON_OPTIONS


def read_platform_txs(spark: SparkSession, path: str, p_chain_id: int = 0) -> DataFrame:
    """One row per transaction with its JSON body as VARIANT."""
    return platform_txs(spark.read.schema(schemas.PLATFORM_BLOCK).options(**JSON_OPTIONS).json(path), p_chain_id)


def platform_txs(blocks: DataFrame, p_chain_id: int | Column = 0) -> DataFrame:
    """Platform blocks to the p_chain_txs layout, with missing block times filled in."""
    chain = p_chain_id if isinstance(p_chain_id, Column) else F.lit(p_chain_id)
    txs = blocks.select(
        chain.cast("bigint").alias("p_chain_id"),
        "height",
        F.timestamp_seconds("timestamp").alias("block_time"),
        F.explode("transactions").alias("tx"),
    ).select(
        "p_chain_id",
        "height",
        "block_time",
        F.col("tx.txID").alias("tx_id"),
        tx_type_name("tx.txType").alias("tx_type"),
        F.try_parse_json("tx.txData").alias("tx_data"),
    )
    advance = F.when(
        F.col("tx_type") == "AdvanceTime", F.timestamp_seconds(json_field("tx_data", "time", "bigint"))
    )
    # times are filled on a slim table of blocks: the transaction bodies do not take part in the sort
    heights = (
        txs.withColumn("_advance", advance)
        .groupBy("p_chain_id", "height")
        .agg(F.max("block_time").alias("block_time"), F.max("_advance").alias("advance_time"))
    )
    times = fill_block_time(heights).select("p_chain_id", "height", F.col("block_time").alias("_time"))
    return txs.join(times, ["p_chain_id", "height"]).select(
        "tx_id", "tx_type", F.col("height").alias("block_number"), F.col("_time").alias("block_time"), "p_chain_id", "tx_data"
    )


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """Registry entries: every chain.json below the folder that names a subnet."""
    entries = (
        spark.read.schema(schemas.REGISTRY_ENTRY)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "chain.json")
        .option("multiLine", True)
        .json(path)
    )
    return registry(entries)


def registry(entries: DataFrame, as_of: Column | None = None) -> DataFrame:
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    return entries.where(F.coalesce(F.col("subnetId"), F.lit("")) != "").select(
        F.col("subnetId").alias("subnet_id"),
        text("name").alias("name"),
        text("description").alias("description"),
        text("logo").alias("logo_url"),
        text("website").alias("website_url"),
        (F.current_timestamp() if as_of is None else as_of).alias("last_updated"),
    )


def read_validator_snapshot(spark: SparkSession, path: str, p_chain_id: int = 0) -> DataFrame:
    """Current-validator answers, one JSON object per line."""
    return validator_state(spark.read.schema(schemas.VALIDATOR_INFO).json(path), p_chain_id)


def validator_state(snapshot: DataFrame, p_chain_id: int = 0, as_of: Column | None = None) -> DataFrame:
    """Snapshot entries as state rows.

    Entries without a validation id take the transaction id; an entry with one and no balance is inactive.
    """
    has_id = F.coalesce(F.col("validationID"), F.lit("")) != ""
    balance = to_uint_or_zero("balance")
    at = lambda c: F.timestamp_seconds(F.coalesce(F.col(c).try_cast("bigint"), F.lit(0)))
    zero = F.lit(0).cast("decimal(20,0)")
    return snapshot.select(
        F.col("subnetID").alias("subnet_id"),
        F.when(has_id, F.col("validationID")).otherwise(F.col("txID")).alias("validation_id"),
        F.col("nodeID").alias("node_id"),
        balance.alias("balance"),
        to_uint_or_zero("weight").alias("weight"),
        at("startTime").alias("start_time"),
        at("endTime").alias("end_time"),
        F.coalesce(F.col("uptime").try_cast("double"), F.lit(0.0)).alias("uptime_percentage"),
        (~(has_id & (balance == 0))).alias("active"),
        *[zero.alias(c) for c in ("initial_deposit", "total_topups", "refund_amount", "fees_paid")],
        (F.current_timestamp() if as_of is None else as_of).alias("last_updated"),
        F.lit(p_chain_id).cast("bigint").alias("p_chain_id"),
    )
