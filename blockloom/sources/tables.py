"""Stored tables: writing, deleting, measuring, delivering."""

from __future__ import annotations

import uuid
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockloom.operators.versioned import only_new

# Partition columns and file order of the raw tables.
RAW_LAYOUT = {
    "raw_blocks": ["block_number"],
    "raw_txs": ["block_number", "transaction_index"],
    "raw_traces": ["block_number", "transaction_index"],
    "raw_logs": ["block_time", "address", "topic0"],
}
RAW_PARTITIONS = ["chain_id", "block_date"]
BATCH = "batch"  # the innermost partition: which write the rows came with
TARGET_BYTES = 256 << 20  # of a file of a merged day
KEPT_TABLES = ("raw_blocks", "raw_txs", "raw_traces", "raw_logs", "block_days", "p_chain_txs", "sync_watermark", "chain_status")


def write_table(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    order: list[str] | None = None,
    mode: str = "append",
    max_records_per_file: int | None = None,
    dynamic: bool = False,
) -> None:
    """Parquet write with sorted files, so that min/max statistics prune, and bounded file sizes.

    ``dynamic`` with mode overwrite replaces the partitions that have rows in ``df`` and leaves all others.
    """
    if order:
        df = df.sortWithinPartitions(*(partition_by or []), *order)
    writer = df.write.mode(mode)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_raw(df: DataFrame, root: str, table: str, load: str = "batch", max_records_per_file: int | None = None, batch: str | None = None) -> None:
    """Write to a raw table, partitioned by chain, day and batch.

    A bulk load is range-partitioned by (chain, day, order key) first: few files per day, and a
    chain-day too large for one task is split by block.  Small micro-batches skip that shuffle.
    A named ``batch`` that comes again replaces what it wrote before, files of a broken write included.
    """
    order = RAW_LAYOUT[table]
    df = df.withColumns({"block_date": F.to_date("block_time"), BATCH: F.lit(batch or "append")})
    if load == "batch":
        df = df.repartitionByRange(*RAW_PARTITIONS, *order)
    if batch is None:
        write_table(df, f"{root}/{table}", [*RAW_PARTITIONS, BATCH], order, "append", max_records_per_file)
    else:
        write_table(df, f"{root}/{table}", [*RAW_PARTITIONS, BATCH], order, "overwrite", max_records_per_file, dynamic=True)


def write_of_chain(df: DataFrame, path: str, chain_id: int, partition_by: list[str] | None = None) -> None:
    """Append rows of one chain to a table that is partitioned by chain first.

    The chain's folder is written to by itself, so that runs of several chains at the same time do not meet in one folder.
    """
    writer = df.drop("chain_id").write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{path}/chain_id={int(chain_id)}")


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    """A stored table, or None before its first write."""
    path = f"{root}/{table}"
    return spark.read.parquet(path) if path_exists(spark, path) else None


def stored_blocks(spark: SparkSession, root: str, table: str, chain_id, low, high, batch: str) -> DataFrame | None:
    """(chain_id, block_number) that other batches have stored in the days from ``low`` to ``high``, from those folders alone.

    Joins with it are by shuffle: Spark's estimate, from the size of two columns in compressed files, would send millions of
    blocks to the driver to be broadcast.
    """
    stored = read_table(spark, root, table)
    if stored is None:
        return None
    mine = stored.where((F.col("chain_id") == chain_id) & F.col("block_date").between(F.lit(low), F.lit(high)) & (F.col(BATCH) != batch))
    return mine.select("chain_id", "block_number").distinct().hint("merge")


def write_new(df: DataFrame, root: str, table: str, batch: str, known: DataFrame | None, load: str = "stream", blocks: DataFrame | None = None) -> None:
    """Write a batch's rows without the blocks that other batches have stored (``known``).

    What the batch itself wrote before is replaced, so one that broke half-way through a block is whole after its repeat.
    ``blocks`` are the (chain_id, block_number) of all rows: if others hold none or all of them, the rows need no shuffle.
    """
    if known is not None and blocks is not None:
        marked = blocks.join(known.withColumn("held", F.lit(True)), ["chain_id", "block_number"], "left")
        total, held = marked.agg(F.count("*"), F.count("held")).first()
        if held == total:
            return
        known = known if held else None
    write_raw(only_new(df, known, ["chain_id", "block_number"]), root, table, load, batch=batch)


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs(spark, path)
    return fs.exists(jpath)


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs(spark, path)
    return fs.delete(jpath, True)


# --- merging small batches ---------------------------------------------------------------


def batch_files(spark: SparkSession, root: str, table: str, chain_id: int) -> DataFrame:
    """(day, batch, length) of every file of a chain's raw table, as the folders are named."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(f"{root}/{table}/chain_id={int(chain_id)}")
    part = lambda name: F.regexp_extract("path", f"/{name}=([^/]+)/", 1)
    return files.select(part("block_date").alias("day"), part(BATCH).alias("batch"), "length")


def merge_days(spark: SparkSession, root: str, table: str, chain_id: int, before: date, target_bytes: int = TARGET_BYTES) -> list[str]:
    """Rewrite days before ``before`` that hold many more files than their bytes need; returns these days.

    The rows of a day's batches go to one batch of files of about ``target_bytes``, in the table's order and without
    overlap.  They are written beside the table first, and then each day changes over by itself: batches that came after
    the listing stay as they are, and a run that broke off is completed by the next one.  While a day changes over it can
    be seen without rows, never with rows twice; a query that has listed the day's old files has to be repeated.  A
    micro-batch that comes again finds its blocks in the merged batch and writes none.  One merge at a time may run for
    a chain's table.
    """
    home, staged = f"{root}/{table}/chain_id={int(chain_id)}", f"{root}/_merging/{table}/chain_id={int(chain_id)}"
    _change_over(spark, home, staged)
    if not path_exists(spark, home):
        return []
    files = batch_files(spark, root, table, chain_id).where(F.col("day") < before.isoformat())
    days = files.groupBy("day").agg(F.count("*").alias("files"), F.sum("length").alias("bytes"), F.collect_set("batch").alias("batches"))
    # at most two files more than needed come from the borders of the ranges
    many = days.where(F.col("files") > 2 * F.ceil(F.col("bytes") / target_bytes) + 1).collect()
    if not many:
        return []
    parts = [(r.day, b) for r in many for b in sorted(r.batches)]
    spark.createDataFrame(parts, "day string, batch string").coalesce(1).write.mode("overwrite").parquet(f"{staged}/sources")
    rows = spark.read.option("basePath", home).parquet(*[f"{home}/block_date={d}/{BATCH}={b}" for d, b in parts])
    order = ["block_date", *RAW_LAYOUT[table]]
    merged = rows.withColumn(BATCH, F.lit(f"merged-{uuid.uuid4().hex[:12]}"))
    count = max(1, -(-sum(r.bytes for r in many) // target_bytes))
    write_table(merged.repartitionByRange(count, *order), f"{staged}/rows", ["block_date", BATCH], RAW_LAYOUT[table], "overwrite")
    _change_over(spark, home, staged)
    return sorted(r.day for r in many)


def _change_over(spark: SparkSession, home: str, staged: str) -> None:
    """Put completely staged days in the place of the batches they were made of; what is in place already is passed over."""
    if path_exists(spark, f"{staged}/rows/_SUCCESS"):
        batches: dict[str, list[str]] = {}
        for r in spark.read.parquet(f"{staged}/sources").collect():  # a name for each folder to be deleted
            batches.setdefault(r.day, []).append(r.batch)
        for day, names in batches.items():
            fs, come = _fs(spark, f"{staged}/rows/block_date={day}")
            for made in fs.listStatus(come) if fs.exists(come) else []:
                for name in names:
                    delete_path(spark, f"{home}/block_date={day}/{BATCH}={name}")
                if not fs.rename(made.getPath(), _fs(spark, f"{home}/block_date={day}/{made.getPath().getName()}")[1]):
                    raise OSError(f"{made.getPath()} could not be moved to {home}")
    delete_path(spark, staged)


def purge_chain(spark: SparkSession, root: str, chain_id: int, tables=tuple(RAW_LAYOUT), marks=None, status=None) -> list[str]:
    """Delete one chain's partitions of the raw tables; returns the folders deleted.

    ``marks`` are stores whose marks of the chain are reset first, so that a resumed sync and the indexers start anew;
    ``status`` is the table of chain statuses, in which the chain then counts as removed.
    """
    for store in [] if marks is None else marks if isinstance(marks, (list, tuple)) else [marks]:
        store.reset(chain_id)
    if status is not None:
        status.remove(chain_id)
    gone = []
    for table in tables:
        path = f"{root}/{table}/chain_id={int(chain_id)}"
        fs, jpath = _fs(spark, path)
        if fs.exists(jpath):
            fs.delete(jpath, True)
            gone.append(path)
    return gone


def drop_derived(spark: SparkSession, root: str, everything: bool = False, keep=KEPT_TABLES) -> list[str]:
    """Delete every calculated table below ``root``; raw tables stay unless ``everything``."""
    fs, jroot = _fs(spark, root)
    if not fs.exists(jroot):
        return []
    gone = []
    for status in fs.listStatus(jroot):
        name = status.getPath().getName()
        if status.isDirectory() and not name.startswith(("_", ".")) and (everything or name not in keep):
            fs.delete(status.getPath(), True)
            gone.append(name)
    return sorted(gone)


def table_stats(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Rows, bytes and bytes per row of Parquet tables, plus GB per 1e9 transactions of the whole set.

    Row counts come from Parquet footers and sizes from the file listing; no column is read.
    """
    parts = []
    for name, path in paths.items():
        rows = spark.read.parquet(path).agg(F.count("*").alias("rows"))
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
        size = files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("size_bytes"))
        parts.append(
            rows.select(F.lit(name).alias("table"), "rows", F.lit(0).cast("bigint").alias("size_bytes")).unionByName(
                size.select(F.lit(name).alias("table"), F.lit(0).cast("bigint").alias("rows"), "size_bytes")
            )
        )
    stats = reduce(DataFrame.unionByName, parts).groupBy("table").agg(F.sum("rows").alias("rows"), F.sum("size_bytes").alias("size_bytes"))
    return stats.withColumn("bytes_per_row", F.when(F.col("rows") > 0, F.col("size_bytes") / F.col("rows")))


def gb_per_billion(stats: DataFrame, table: str = "raw_txs") -> DataFrame:
    """Storage of all tables per 1e9 rows of ``table``, in GB."""
    total = stats.agg(F.sum("size_bytes").alias("total_bytes"), F.sum("rows").alias("total_rows"), F.sum(F.when(F.col("table") == table, F.col("rows"))).alias("tx_rows"))
    gb = F.when(F.col("tx_rows") > 0, F.col("total_bytes") / F.col("tx_rows") * 1e9 / 2**30).otherwise(F.lit(0.0))
    return total.select("total_rows", "total_bytes", gb.alias("gb_per_billion"))


def to_json_rows(df: DataFrame) -> DataFrame:
    """One JSON object per row, in column ``json``; bytes as 0x-hex text."""
    cols = [
        F.concat(F.lit("0x"), F.lower(F.hex(f.name))).alias(f.name) if f.dataType.typeName() == "binary" else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(F.to_json(F.struct(*cols)).alias("json"))
