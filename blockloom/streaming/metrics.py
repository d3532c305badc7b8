"""Metrics over streams.

Hours, days and weeks are event-time windows that are emitted once, when closed.  Calendar
months have no fixed length: their starts are the event time, so a month is emitted once a row of
a later one is there.  Everything cumulative is brought up to date per micro-batch from what
earlier runs have carried.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from blockloom.constants import GRANULARITIES
from blockloom.functions.periods import floor_period, following_period, period_seconds, period_start, utc_lit, utc_text, utc_time
from blockloom.functions.text import trunc_div
from blockloom.plans import carried
from blockloom.plans.indexer import CARRIED, WatermarkStore, run_granular, write_metrics
from blockloom.plans.metrics import SPECS, SERIES, VALUE, MetricSpec, addresses, current_metrics, measure_sum, metric_batch
from blockloom.sources.tables import RAW_LAYOUT, path_exists, read_table

# Window lengths; the week starts on Sunday, three days after the epoch's Thursday.
WINDOWS = {"hour": ("1 hour", None), "day": ("1 day", None), "week": ("7 days", "3 days")}


def _window(ts, granularity: str) -> Column:
    length, offset = WINDOWS[granularity]
    return F.window(ts, length, length, offset) if offset else F.window(ts, length)


def stream_metric(stream: DataFrame, spec: MetricSpec | str, granularity: str, delay: str = "0 seconds") -> DataFrame:
    """A metric of a stream, one row per chain and closed window or ended month (append mode).

    Rows later than ``delay`` are dropped; use ``recompute_late`` to count them.  Distinct
    metrics are estimated with HyperLogLog, whose state does not grow with the addresses.

    A month has ended with the first row, of any chain, of a later month, and rows that come after that are late; there is
    no other delay.  Its state is one row per chain.  Peaks of a month would keep all its seconds: use update_metrics.
    """
    spec = SPECS[spec] if isinstance(spec, str) else spec
    monthly = granularity == "month"
    if not monthly and granularity not in WINDOWS:
        raise ValueError(f"no event-time window for {granularity}; use update_metrics")
    if monthly and (spec.kind == "peak" or delay != "0 seconds"):
        raise ValueError("months have neither peaks nor a delay; use update_metrics")
    if monthly:
        # a second less than the start of the newest month: every earlier one has ended
        df = stream.withColumn("start", period_start("block_time", granularity)).withWatermark("start", "1 second")
        period, time, start = F.col("start"), "start", "start"
    else:
        df = stream.withWatermark("block_time", delay)
        period, time, start = _window("block_time", granularity).alias("w"), "block_time", "w.start"
    if spec.where is not None:
        df = df.where(spec.where())
    measure = measure_sum(spec)
    value = F.col("n")
    if spec.kind == "peak":
        seconds = df.groupBy("chain_id", F.window("block_time", "1 second").alias("s")).agg(measure.alias("n"))
        grouped = seconds.groupBy("chain_id", _window(F.window_time("s"), granularity).alias("w")).agg(F.max("n").alias("n"))
    elif spec.kind == "distinct":
        ends = addresses(df, spec.keys, "chain_id", time)
        grouped = ends.groupBy("chain_id", period).agg(F.approx_count_distinct("address").alias("n"))
    elif spec.kind in ("count", "sum", "rate", "max", "avg"):
        aggregate = {"max": lambda: F.max(spec.measure()), "avg": lambda: trunc_div(F.sum(spec.measure().cast(VALUE)), F.count(spec.measure()))}.get(spec.kind, lambda: measure)()
        grouped = df.groupBy("chain_id", period).agg(aggregate.alias("n"))
        if spec.kind == "rate":
            value = trunc_div(value, period_seconds(start, granularity))
    else:
        raise ValueError(f"{spec.kind} metrics are not windowed; use update_metrics")
    return grouped.select(
        "chain_id",
        F.lit(spec.name).alias("metric_name"),
        F.lit(granularity).alias("granularity"),
        F.col(start).alias("period"),
        value.cast(VALUE).alias("value"),
    )


def raw_views(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Stored raw tables that exist."""
    return {t: df for t in RAW_LAYOUT if (df := read_table(spark, root, t)) is not None}


def update_metrics(spark: SparkSession, root: str, chain_id: int, names: list[str] | None = None) -> int:
    """Per micro-batch: compute all periods that have become complete, months included."""
    tables = raw_views(spark, root)
    if "raw_blocks" not in tables:
        return 0
    latest = tables["raw_blocks"].where(F.col("chain_id") == chain_id).agg(utc_text(F.max("block_time")).alias("t")).first().t
    if latest is None:
        return 0
    return run_granular(spark, tables, root, WatermarkStore(spark, f"{root}/indexer_watermarks"), chain_id, utc_time(latest), names)


def recompute_late(spark: SparkSession, root: str, chain_id: int, low: datetime, high: datetime, names: list[str] | None = None, grains: tuple[str, ...] = GRANULARITIES, buckets: int = 64) -> None:
    """Recompute the periods between two times, after late blocks arrived there; newer versions replace the old.

    Cumulative metrics are recomputed from there on for all periods stored, since late rows raise every later value.  What is
    carried from run to run takes in the late hours alone; metrics that no run has carried yet are counted from the beginning.
    Of a metric with a mark only periods up to it are written: later ones have not ended, or the next run computes them.
    """
    tables = raw_views(spark, root)
    wanted = [n for n in (names or SPECS) if SPECS[n].source in tables]
    marks = WatermarkStore(spark, f"{root}/indexer_watermarks").marks(chain_id)
    done = {n: m.last_period for n in wanted if (m := marks.get((CARRIED + n, "hour"))) and m.last_period}
    running = [n for n in wanted if SPECS[n].kind.startswith("cumulative") and n not in done]
    bounded = [n for n in wanted if n not in running and n not in done]
    for end in sorted(set(done.values())):
        carried.recount(spark, tables, root, chain_id, [n for n in done if done[n] == end], low, high, end, buckets)
    parts = []
    for granularity in grains:
        first, end = floor_period(low, granularity), following_period(high, granularity)
        if bounded:
            parts.append(_ended(metric_batch(tables, bounded, chain_id, utc_lit(first), utc_lit(end), grains=(granularity,)), marks, granularity))
        onward = [metric_batch(tables, running, chain_id, utc_lit(first), grains=(granularity,))] if running else []
        onward += [carried.series(spark, root, chain_id, [n], (granularity,), first, done[n]) for n in done]
        if onward:
            later = _for_stored(reduce(DataFrame.unionByName, onward), root, utc_lit(first), utc_lit(end))
            parts.append(_ended(later, marks, granularity))
    if parts:
        write_metrics(reduce(DataFrame.unionByName, parts), root, chain_id)


def _ended(series: DataFrame, marks: dict, granularity: str) -> DataFrame:
    """Periods up to the marks of their metrics; all of metrics without one."""
    for (name, grain), mark in marks.items():
        if grain == granularity and name.startswith("evm_metrics/") and mark.last_period:
            metric_name = name.removeprefix("evm_metrics/")
            series = series.where((F.col("metric_name") != metric_name) | (F.col("period") <= utc_lit(mark.last_period)))
    return series


def _for_stored(onward: DataFrame, root: str, first: Column, end: Column) -> DataFrame:
    """Cumulative values of the periods before ``end`` and of all later ones that are stored.

    A stored period may have no row of its own any more, if what was new in it now appears earlier; it has the value of
    the period before.
    """
    spark, keys = onward.sparkSession, ["chain_id", "metric_name", "granularity"]
    here = onward.withColumn("wanted", F.col("period") < end)
    if path_exists(spark, f"{root}/metrics"):
        series = onward.select(*keys).distinct()
        stored = spark.read.parquet(f"{root}/metrics").join(series, keys, "left_semi").where(F.col("period") >= first)
        stored = current_metrics(stored.withColumn("chain_id", F.col("chain_id").cast(onward.schema["chain_id"].dataType)))
        here = here.unionByName(stored.select(*keys, "period", F.lit(None).cast(VALUE).alias("value"), F.lit(True).alias("wanted")))
    by_period = here.groupBy(*keys, "period").agg(F.max("value").alias("value"), F.max("wanted").alias("wanted"))
    so_far = Window.partitionBy(*keys).orderBy("period").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return by_period.withColumn("value", F.max("value").over(so_far)).where("wanted AND value IS NOT NULL").select(*SERIES)


# --- first appearances -------------------------------------------------------------------


def update_first_seen(batch: DataFrame, path: str, keys: tuple[str, ...] = ("from", "to"), ts: str = "block_time", buckets: int = 64) -> DataFrame:
    """Add a batch's addresses to a table of first appearances; returns those that are new or appear earlier than known.

    Only the buckets of the batch's addresses are read and added to.  A batch that comes again adds nothing.
    """
    fresh = addresses(batch, keys, "chain_id", F.col(ts)).groupBy("chain_id", "address").agg(F.min(ts).alias("first_seen"))
    seen = carried.FirstSeen(batch.sparkSession, path, buckets).add(fresh)
    return seen.where("later").select("chain_id", "address", "first_seen")


def read_first_seen(spark: SparkSession, path: str, buckets: int = 64) -> DataFrame:
    return carried.FirstSeen(spark, path, buckets).read()


def start_first_seen(
    stream: DataFrame, path: str, checkpoint: str, keys: tuple[str, ...] = ("from", "to"), ts: str = "block_time", buckets: int = 64, once: bool = False, trigger: str = "1 minute"
) -> StreamingQuery:
    """Keep a table of first appearances up to date with a stream of traces; it can be stopped and started at any time."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        update_first_seen(batch, path, keys, ts, buckets)

    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=trigger)).start()
