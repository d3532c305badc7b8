"""Cumulative metrics carried forward: a run reads new rows only, whatever the length of the history.

Two small tables below the root keep what earlier runs found out:

``hourly``       rows, or addresses seen for the first time, of every hour: (chain_id, metric_name, hour, n, computed_at).
                 A count is absolute and the newest one of an hour holds, so a repeated run replaces what it wrote before.
``first_seen``   first appearance of every address of a metric, spread over buckets by a hash of the address.  It is only
                 ever appended to, with addresses that are new or appear earlier than known; readers take the minimum, so
                 neither a repeat nor the order of writes matters.

A series at any granularity is a running sum of the hourly counts, a few thousand rows a year.
"""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockloom.functions.periods import floor_period, utc_lit
from blockloom.operators.filters import for_chain, in_time_range
from blockloom.operators.versioned import latest_by_key
from blockloom.operators.windows import running_sum
from blockloom.plans.metrics import SERIES, SPECS, VALUE, MetricSpec, first_seen, roll_up
from blockloom.session import cut_lineage
from blockloom.sources.tables import path_exists, write_of_chain

HOURLY = "chain_id bigint, metric_name string, hour timestamp, n bigint, computed_at timestamp"
HOUR = timedelta(hours=1)


class FirstSeen:
    """First appearances by (chain_id, address) in a table of ``buckets`` folders a chain.

    A batch reads the buckets that its addresses fall into and appends to those.  Choose ``buckets`` so that one holds some
    megabytes; the number belongs to the table and cannot change later.
    """

    SCHEMA = "address binary, first_seen timestamp, of int, chain_id bigint, bucket int"

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path, buckets

    def _stored(self) -> DataFrame | None:
        if not path_exists(self.spark, self.path):
            return None
        if not path_exists(self.spark, f"{self.path}/of={self.buckets}"):
            raise ValueError(f"{self.path} has another number of buckets than {self.buckets}")
        return self.spark.read.schema(self.SCHEMA).parquet(self.path)

    def read(self) -> DataFrame:
        """(chain_id, address, first_seen), one row an address."""
        stored = self._stored()
        if stored is None:
            return self.spark.createDataFrame([], "chain_id bigint, address binary, first_seen timestamp")
        return stored.groupBy("chain_id", "address").agg(F.min("first_seen").alias("first_seen"))

    def known(self, chains: list[int], buckets: list[int]) -> DataFrame | None:
        """(chain_id, bucket, address, before) of the given folders alone."""
        stored = self._stored()
        if stored is None:
            return None
        mine = stored.where(F.col("chain_id").isin(chains) & F.col("bucket").isin(buckets))
        return mine.groupBy("chain_id", "bucket", "address").agg(F.min("first_seen").alias("before"))

    def add(self, fresh: DataFrame) -> DataFrame:
        """Add (chain_id, address, first_seen), one row an address; returns them with ``before``, null if unknown so far.

        ``first_seen`` of the result is the first appearance of all.
        """
        bucket = F.pmod(F.xxhash64("address"), F.lit(self.buckets)).cast("int")
        fresh = cut_lineage(fresh.select(F.col("chain_id").cast("bigint").alias("chain_id"), "address", "first_seen", bucket.alias("bucket")))
        touched = fresh.agg(F.collect_set("chain_id").alias("chains"), F.collect_set("bucket").alias("buckets")).first()
        known = self.known(touched.chains, touched.buckets)
        if known is None:
            seen = fresh.withColumns({"before": F.lit(None).cast("timestamp"), "later": F.lit(True)})
        else:
            seen = fresh.join(known, ["chain_id", "bucket", "address"], "left").withColumn("later", F.col("before").isNull() | (F.col("before") > F.col("first_seen")))
            seen = cut_lineage(seen.withColumn("first_seen", F.least("first_seen", "before")))
        if touched.chains:
            # a bucket goes to one task, so a batch leaves one file in it
            new = seen.where("later").select("address", "first_seen", F.lit(self.buckets).alias("of"), "chain_id", "bucket")
            new = new.repartition("chain_id", "bucket").sortWithinPartitions("chain_id", "bucket", "address")
            if len(touched.chains) == 1:
                write_of_chain(new.drop("of"), f"{self.path}/of={self.buckets}", touched.chains[0], ["bucket"])
            else:
                new.write.mode("append").partitionBy("of", "chain_id", "bucket").parquet(self.path)
        return seen.select("chain_id", "address", "first_seen", "before", "later")


def _table(root: str, name: str) -> str:
    return f"{root}/first_seen/{name}"


def new_rows(tables: dict[str, DataFrame], spec: MetricSpec, chain_id: int, first: datetime | None, end: datetime) -> DataFrame:
    """What a run from ``first`` reads for a metric: with a stored table, the days of the range alone."""
    rows = in_time_range(for_chain(tables[spec.source], chain_id), "block_time", utc_lit(first) if first else None, utc_lit(end))
    return rows if spec.where is None else rows.where(spec.where())


def _hours(df: DataFrame, ts: str, name: str) -> DataFrame:
    by_hour = df.groupBy("chain_id", F.date_trunc("hour", ts).alias("hour")).agg(F.count("*").alias("n"))
    return by_hour.select(F.col("chain_id").cast("bigint").alias("chain_id"), F.lit(name).alias("metric_name"), "hour", "n")


def _write(parts: list[DataFrame], root: str, chain_id: int) -> None:
    out = reduce(DataFrame.unionByName, parts).withColumn("computed_at", F.current_timestamp())
    write_of_chain(out.coalesce(1), f"{root}/hourly", chain_id)


def advance(spark: SparkSession, tables: dict[str, DataFrame], root: str, chain_id: int, names: list[str], first: datetime | None, end: datetime, buckets: int = 64) -> None:
    """Count the hours from ``first`` (None: the beginning) up to and excluding ``end``, both whole hours."""
    parts = []
    for name in names:
        spec = SPECS[name]
        rows = new_rows(tables, spec, chain_id, first, end)
        if spec.kind == "cumulative":
            parts.append(_hours(rows, "block_time", name))
            continue
        seen = FirstSeen(spark, _table(root, name), buckets).add(first_seen(rows, spec.keys, "block_time"))
        fresh = seen if first is None else seen.where(F.col("first_seen") >= utc_lit(first))
        parts.append(_hours(fresh, "first_seen", name))
    if parts:
        _write(parts, root, chain_id)


def hourly(spark: SparkSession, root: str) -> DataFrame:
    """The newest count of every hour; hours without anything new have no row, or one of 0."""
    if not path_exists(spark, f"{root}/hourly"):
        return spark.createDataFrame([], HOURLY).drop("computed_at")
    stored = spark.read.schema(HOURLY).parquet(f"{root}/hourly")
    return latest_by_key(stored, ["chain_id", "metric_name", "hour"], "computed_at", ["n"]).drop("computed_at")


def recount(spark: SparkSession, tables: dict[str, DataFrame], root: str, chain_id: int, names: list[str], low: datetime, high: datetime, end: datetime, buckets: int = 64) -> None:
    """Bring the counts up to date after late rows between two times; ``end`` is how far the counts go.

    The hours of the late rows are read again.  An address that now appears earlier leaves the hour it counted in before, so
    from ``low`` on the counts of first appearances are taken anew from their table.
    """
    first = floor_period(low, "hour")
    last = min(floor_period(high, "hour") + HOUR, end)
    if last <= first:
        return
    advance(spark, tables, root, chain_id, names, first, last, buckets)
    parts = []
    for name in names:
        if SPECS[name].kind == "cumulative":
            continue
        seen = for_chain(FirstSeen(spark, _table(root, name), buckets).read(), chain_id).where((F.col("first_seen") >= utc_lit(first)) & (F.col("first_seen") < utc_lit(end)))
        now = _hours(seen, "first_seen", name)
        before = hourly(spark, root).where((F.col("chain_id") == chain_id) & (F.col("metric_name") == name) & (F.col("hour") >= utc_lit(first)))
        zero = before.select("chain_id", "metric_name", "hour", F.lit(0).cast("bigint").alias("n"))
        parts.append(now.unionByName(zero).groupBy("chain_id", "metric_name", "hour").agg(F.max("n").alias("n")))
    if parts:
        counted = cut_lineage(reduce(DataFrame.unionByName, parts))  # read before the table it is read from grows
        _write([counted], root, chain_id)


def series(spark: SparkSession, root: str, chain_id: int, names: list[str], grains: tuple[str, ...], first: datetime | None, end: datetime) -> DataFrame:
    """Cumulative values of the periods in [first, end) in which something is new, as ``metric_batch`` gives them."""
    counts = hourly(spark, root).where((F.col("chain_id") == chain_id) & F.col("metric_name").isin(names) & (F.col("hour") < utc_lit(end)) & (F.col("n") > 0))
    total = running_sum(roll_up(counts, grains, ["metric_name"], [F.sum("n").alias("n")]), "n", "period", ["chain_id", "metric_name", "granularity"], "value")
    if first is not None:
        total = total.where(F.col("period") >= utc_lit(first))
    return total.withColumn("value", F.col("value").cast(VALUE)).select(*SERIES)
