"""Nested block records in JSON files, batch and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockloom import schemas
from blockloom.functions.hexes import hex_to_uint

# A call tree nests two JSON levels per call and calls nest up to 1024 deep; parser defaults would
# turn such a record into NULLs.  A record that still cannot be read stops the job.
JSON_OPTIONS = {"mode": "FAILFAST", "maxNestingDepth": 10_000, "maxStringLen": 2**31 - 1}

# Landing folders may be grouped as block_group=<number // BLOCKS_PER_GROUP>.
BLOCKS_PER_GROUP = 100_000


def read_blocks(spark: SparkSession, path: str, from_block: int | None = None, to_block: int | None = None) -> DataFrame:
    """Nested block records, one JSON document per line, optionally of an inclusive block range.

    If the folder is partitioned by block_group, only the groups of the range are listed and read.
    """
    grouped = _is_grouped(spark, path)
    schema = schemas.NESTED_BLOCK + (", block_group bigint" if grouped else "")
    df = spark.read.schema(schema).options(**JSON_OPTIONS).json(path)
    number = hex_to_uint("block.number", 32)
    if from_block is not None:
        df = df.where(number >= from_block)
        df = df.where(F.col("block_group") >= from_block // BLOCKS_PER_GROUP) if grouped else df
    if to_block is not None:
        df = df.where(number <= to_block)
        df = df.where(F.col("block_group") <= to_block // BLOCKS_PER_GROUP) if grouped else df
    return df.drop("block_group")


def _is_grouped(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/block_group=*")
    found = jpath.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(jpath)
    return found is not None and len(found) > 0


def stream_blocks(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    """The same records as an unbounded stream over the files that arrive in the folder."""
    return spark.readStream.schema(schemas.NESTED_BLOCK).options(**JSON_OPTIONS).option("maxFilesPerTrigger", max_files).json(path)
