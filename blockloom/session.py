"""Session settings the library relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that change results (time zone) or keep plans adaptive.  Sizes such as
# spark.sql.shuffle.partitions belong to the cluster, so they are not set here.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split skewed joins even where an aggregation on the same key follows
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # the JVM never compiles a method above 8000 bytes; a stage that would be one runs operator by operator, in short methods
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # call traces, the only data handed to Python, can be megabytes each
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    # so a batch is bounded by its bytes too: the JVM, the wire and the worker each hold one
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Set the SQL settings every operator assumes on an existing session."""
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", shuffle_partitions: int = 8, app: str = "blockloom", extra: dict | None = None) -> SparkSession:
    """A single-machine session for tests and bench.py."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BLOCKLOOM_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.extraJavaOptions", "-Duser.timezone=UTC")
    )
    for key, value in {**REQUIRED, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir, for data that outlives executors.

    Only a local session without the setting gets a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a shared folder")
    return tempfile.mkdtemp(prefix="blockloom-")


def scratch(spark: SparkSession) -> str:
    """A new, unused folder path below the shared folder."""
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` to shared storage, so that lost executors never cost more than the work since."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)
