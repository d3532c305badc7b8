"""Continuous ingest of block files into the raw tables."""

from __future__ import annotations

import hashlib
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from blockloom.operators.normalize import normalize_blocks, normalize_logs, normalize_traces, normalize_txs, tx_rows
from blockloom.plans.indexer import SYNC, WatermarkStore, write_block_days
from blockloom.plans.status import ChainStatus
from blockloom.sources.blocks import stream_blocks
from blockloom.sources.tables import stored_blocks, write_new


def raw_tables(nested: DataFrame, chain_id) -> dict[str, DataFrame]:
    """The four flat tables of nested block records."""
    rows = tx_rows(nested, chain_id)
    return {
        "raw_blocks": normalize_blocks(nested, chain_id),
        "raw_txs": normalize_txs(rows),
        "raw_traces": normalize_traces(rows),
        "raw_logs": normalize_logs(rows),
    }


def write_batch(nested: DataFrame, root: str, chain_id: int, load: str = "stream", batch: str | None = None) -> int | None:
    """Write one batch to all four tables at the same time, then its days and the sync watermark.

    ``batch`` names the write: a repeat replaces what was written under the name before, whole or not.  Blocks that other
    batches have stored are skipped.  Without a name it is made from the lowest and the highest block.  Returns the latter.
    """
    spark = nested.sparkSession
    nested = nested.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        tables = raw_tables(nested, chain_id)
        blocks = tables["raw_blocks"].select("chain_id", "block_number", "block_time").persist(StorageLevel.MEMORY_AND_DISK)
        day = F.to_date("block_time")
        low, high, first, top = blocks.agg(F.min(day), F.max(day), F.min("block_number"), F.max("block_number")).first()
        if top is None:
            return None
        name = batch or f"blocks-{first}-{top}"

        def write(table: str) -> None:
            write_new(tables[table], root, table, name, stored_blocks(spark, root, table, chain_id, low, high, name), load, blocks)

        with ThreadPoolExecutor(len(tables)) as pool:
            for job in [pool.submit(write, table) for table in tables]:
                job.result()
        write_block_days(blocks, root)
        store = WatermarkStore(spark, f"{root}/sync_watermark")
        known = store.get(chain_id, SYNC)
        if known is None or known.last_block_num is None or top > known.last_block_num:
            store.set(chain_id, SYNC, "", None, top, known)
        blocks.unpersist()
        return top
    finally:
        nested.unpersist()


def start_ingest(
    spark: SparkSession,
    src: str,
    root: str,
    chain_id: int,
    checkpoint: str,
    trigger: str = "1 second",
    once: bool = False,
    max_files: int = 100,
    after_batch=None,
    chain_name: str | None = None,
) -> StreamingQuery:
    """Start ingest as a stream; ``once`` processes what is there and stops.

    ``after_batch(batch, batch_id)`` runs behind the writes, for example to bring metrics up to
    date; leave it out for a fast initial sync.  With ``chain_name`` the chain's status is kept too.
    """

    # batches of a stream have the same number and content whenever they are repeated; another stream has another name
    stream = hashlib.blake2b(checkpoint.encode(), digest_size=4).hexdigest()

    def handle(batch: DataFrame, batch_id: int) -> None:
        top = write_batch(batch, root, chain_id, batch=f"{stream}-{batch_id}")
        if chain_name is not None and top is not None:
            ChainStatus(spark, f"{root}/chain_status").upsert(chain_id, chain_name, top)
        if after_batch is not None:
            after_batch(batch, batch_id)

    writer = stream_blocks(spark, src, max_files).writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=trigger)
    return writer.start()


def dedup_stream(stream: DataFrame, keys: list[str], ts: str = "block_time", delay: str = "10 minutes") -> DataFrame:
    """Drop repeated keys that arrive within ``delay`` of each other; state stays bounded by the watermark."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)

