"""What is known of each chain: its name, its newest block, how far it is synced."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockloom.operators.versioned import latest_by_key, upsert
from blockloom.plans.dashboards import sync_status
from blockloom.plans.indexer import SYNC, WatermarkStore
from blockloom.sources.tables import path_exists


class ChainStatus:
    """A versioned table of chains; the newest version of a chain holds, and a removed chain has none."""

    SCHEMA = "chain_id bigint, name string, last_updated timestamp, last_block_on_chain bigint, removed boolean"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def upsert_all(self, rows: DataFrame) -> None:
        """Append versions (chain_id, name, last_updated, last_block_on_chain)."""
        upsert(rows.select("chain_id", "name", "last_updated", "last_block_on_chain", F.lit(False).alias("removed")).coalesce(1), self.path)

    def upsert(self, chain_id: int, name: str, last_block_on_chain: int) -> None:
        row = self.spark.createDataFrame([(chain_id, name, last_block_on_chain)], "chain_id bigint, name string, last_block_on_chain bigint")
        self.upsert_all(row.withColumn("last_updated", F.current_timestamp()))

    def remove(self, chain_id: int) -> None:
        gone = self.spark.createDataFrame([(chain_id,)], "chain_id bigint").select(
            "chain_id", F.lit(None).cast("string").alias("name"), F.current_timestamp().alias("last_updated"), F.lit(None).cast("bigint").alias("last_block_on_chain"), F.lit(True).alias("removed")
        )
        upsert(gone, self.path)

    def current(self) -> DataFrame:
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.SCHEMA).drop("removed")
        stored = self.spark.read.schema(self.SCHEMA).parquet(self.path)
        return latest_by_key(stored, ["chain_id"], "last_updated", ["removed"]).where("NOT removed").drop("removed")


def stored_sync_status(spark: SparkSession, root: str) -> DataFrame:
    """Blocks behind and percent synced of every chain, from the tables that ingest keeps below ``root``."""
    marks = WatermarkStore(spark, f"{root}/sync_watermark").current().where((F.col("indexer_name") == SYNC) & F.col("last_block_num").isNotNull())
    return sync_status(ChainStatus(spark, f"{root}/chain_status").current(), marks.select("chain_id", F.col("last_block_num").alias("block_number")))
