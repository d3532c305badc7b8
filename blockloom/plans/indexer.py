"""Resumable incremental runs: watermarks, pending ranges, specs from files."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timedelta
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockloom import schemas
from blockloom.constants import BLOCKS_PER_BATCH, GRANULARITIES
from blockloom.functions.periods import floor_period, pending_range, utc_lit, utc_text, utc_time
from blockloom.operators.filters import DAY, in_block_range
from blockloom.plans import carried
from blockloom.plans.balances import balance_changes_by_range
from blockloom.plans.dashboards import run_sql
from blockloom.plans.metrics import SPECS, metric_batch
from blockloom.sources.tables import path_exists, write_of_chain

SYNC = "sync"
#: Names of the marks up to which the hours of cumulative metrics are counted.
CARRIED = "carried/"


@dataclass(frozen=True)
class Watermark:
    last_period: datetime | None
    last_block_num: int | None
    epoch: int = 0


class WatermarkStore:
    """Progress per (chain, indexer, granularity): an append-only table of marks that only grow.

    The greatest mark counts, so neither the order of writers nor a repeat matters, and nothing is ever deleted.  A reset
    begins the next epoch, whose marks count more than all of earlier ones.  An append commits whole or not at all.
    """

    KEY = ["chain_id", "indexer_name", "granularity"]

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def table(self) -> DataFrame:
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], schemas.WATERMARKS)
        return self.spark.read.schema(schemas.WATERMARKS).parquet(self.path).drop("write")

    def current(self) -> DataFrame:
        """One row a key; a key that was reset has nulls until it is set again."""
        newest = [F.max(F.struct("epoch", c)).alias(c) for c in ("last_period", "last_block_num")]
        merged = self.table().groupBy(*self.KEY).agg(*newest, F.max("updated_at").alias("updated_at"))
        return merged.select(*self.KEY, "last_period.last_period", "last_block_num.last_block_num", "updated_at", F.col("last_period.epoch").alias("epoch"))

    def marks(self, chain_id: int) -> dict[tuple[str, str], Watermark]:
        """All marks of a chain by (name, granularity), in one read."""
        rows = self.current().where(F.col("chain_id") == chain_id).withColumn("text", utc_text("last_period")).collect()
        return {(r.indexer_name, r.granularity): Watermark(utc_time(r.text), r.last_block_num, r.epoch) for r in rows}

    def get(self, chain_id: int, name: str, granularity: str = "") -> Watermark | None:
        """The current mark, or None before the first run."""
        return self.marks(chain_id).get((name, granularity))

    def set_all(self, chain_id: int, marks: dict[tuple[str, str], Watermark]) -> None:
        """Append marks in one write; ``epoch`` is that of the mark they follow."""
        if not marks:
            return
        text = lambda t: t and t.isoformat(" ")
        rows = [(chain_id, name, grain, text(m.last_period), m.last_block_num, m.epoch) for (name, grain), m in marks.items()]
        entries = self.spark.createDataFrame(rows, "chain_id bigint, indexer_name string, granularity string, period string, last_block_num bigint, epoch bigint")
        self.append(entries.withColumn("last_period", F.col("period").cast("timestamp")))

    def append(self, entries: DataFrame) -> None:
        """Append marks of any chains (chain_id, indexer_name, granularity); what is left out is null, and the epoch 0."""
        given = {"last_period": "timestamp", "last_block_num": "bigint", "epoch": "int"}
        optional = [(F.col(c) if c in entries.columns else F.lit(0 if c == "epoch" else None)).cast(kind).alias(c) for c, kind in given.items()]
        row = entries.select("chain_id", "indexer_name", "granularity", *optional).withColumns({"epoch": F.col("epoch").cast("bigint"), "updated_at": F.current_timestamp()})
        # a folder of its own, since writers that share one can remove each other's unfinished files
        row.coalesce(1).write.parquet(f"{self.path}/write={uuid.uuid4().hex}")

    def set(
        self, chain_id: int, name: str, granularity: str = "", last_period: datetime | None = None, last_block_num: int | None = None, known: Watermark | None = None
    ) -> None:
        """Append a mark; ``known`` is the current one, if the caller has just read it."""
        known = known or self.get(chain_id, name, granularity)
        self.set_all(chain_id, {(name, granularity): Watermark(last_period, last_block_num, known.epoch if known else 0)})

    def reset(self, chain_id: int) -> None:
        """Forget every mark of a chain."""
        self.set_all(chain_id, {key: Watermark(None, None, m.epoch + 1) for key, m in self.marks(chain_id).items()})

    def sync_get(self, chain_id: int) -> int | None:
        row = self.get(chain_id, SYNC)
        return row.last_block_num if row else None

    def sync_set(self, chain_id: int, block_number: int) -> None:
        self.set(chain_id, SYNC, "", None, block_number)

    def sync_reset(self, chain_id: int) -> None:
        """Forget how far a chain was synced."""
        known = self.get(chain_id, SYNC)
        if known:
            self.set_all(chain_id, {(SYNC, ""): Watermark(None, None, known.epoch + 1)})

    def resume_at(self, chain_id: int, start: int = 1) -> int:
        """First block still to sync."""
        last = self.sync_get(chain_id)
        return start if last is None else last + 1


def next_block_range(last: int | None, latest: int, start: int = 1, n: int = BLOCKS_PER_BATCH) -> tuple[int, int] | None:
    """The next inclusive block range after ``last``, at most ``n`` blocks, or None if nothing is pending."""
    first = start if last is None else last + 1
    return None if first > latest else (first, min(latest, first + n - 1))


def run_granular(
    spark: SparkSession, tables: dict[str, DataFrame], root: str, store: WatermarkStore, chain_id: int, latest: datetime,
    names: list[str] | None = None, approx: bool = False, grains: tuple[str, ...] = GRANULARITIES, buckets: int = 64,
) -> int:
    """Compute every complete period after the watermarks; returns the number of writes.

    Metrics that are equally far along are computed together, one scan per source.  Cumulative ones go on from the hourly
    counts of earlier runs, which are brought up to date first, so history is not read again.  Results are appended with
    their time of computation, and readers take the newest, so a repeat is harmless.  Marks are read once and appended once.
    """
    wanted = [n for n in (names or SPECS) if SPECS[n].source in tables]
    marks, moved = store.marks(chain_id), {}
    running = [n for n in wanted if SPECS[n].kind.startswith("cumulative")]
    hour = floor_period(latest, "hour")
    behind: dict[datetime | None, list[str]] = {}
    for name in running:
        mark = marks.get((CARRIED + name, "hour"))
        done = mark.last_period if mark else None  # the end of the hours counted
        if done is None or done < hour:
            behind.setdefault(done, []).append(name)
            moved[CARRIED + name, "hour"] = Watermark(hour, None, mark.epoch if mark else 0)
    for done, group in behind.items():
        carried.advance(spark, tables, root, chain_id, group, done, hour, buckets)
    writes = 0
    for granularity in grains:
        groups: dict[tuple, list[str]] = {}
        for name in wanted:
            key = (f"evm_metrics/{name}", granularity)
            mark = marks.get(key)
            last = mark.last_period if mark else None
            pending = pending_range(last, latest, granularity)
            if pending:
                groups.setdefault((last, *pending, name in running), []).append(name)
                moved[key] = Watermark(_last_start(pending[1], granularity), None, mark.epoch if mark else 0)
        for (last, first, end, on), group in groups.items():
            if on:
                series = carried.series(spark, root, chain_id, group, (granularity,), first if last else None, end)
            else:
                series = metric_batch(tables, group, chain_id, utc_lit(first) if last else None, utc_lit(end), approx, (granularity,))
            write_metrics(series, root, chain_id)
            writes += 1
    store.set_all(chain_id, moved)
    return writes


def write_metrics(series: DataFrame, root: str, chain_id: int) -> None:
    write_of_chain(series.withColumn("computed_at", F.current_timestamp()), f"{root}/metrics", chain_id, ["granularity"])


def _last_start(end: datetime, granularity: str) -> datetime:
    return floor_period(end - timedelta(seconds=1), granularity)


# --- days of block numbers ---------------------------------------------------------------

DAYS = "chain_id bigint, block_date date, first_block bigint, last_block bigint"


def write_block_days(blocks: DataFrame, root: str) -> None:
    """Append the block numbers of each day of a batch; readers merge, so a repeat or another order changes nothing."""
    days = blocks.groupBy(F.col("chain_id").cast("bigint").alias("chain_id"), F.to_date("block_time").alias("block_date"))
    numbers = days.agg(F.min("block_number").alias("first_block"), F.max("block_number").alias("last_block"))
    numbers.coalesce(1).write.mode("append").parquet(f"{root}/block_days")


def block_days(spark: SparkSession, root: str) -> DataFrame | None:
    """(chain_id, block_date, first_block, last_block) of every day, or None before the first write."""
    path = f"{root}/block_days"
    if not path_exists(spark, path):
        return None
    return spark.read.schema(DAYS).parquet(path).groupBy("chain_id", "block_date").agg(F.min("first_block").alias("first_block"), F.max("last_block").alias("last_block"))


def in_days_of_blocks(df: DataFrame, days: DataFrame | None, chain_id: int, first: int, last: int) -> DataFrame:
    """Rows of a block range; a table with days is pruned to those that hold blocks of the range."""
    if days is not None and DAY in df.columns:
        held = days.where((F.col("chain_id") == chain_id) & (F.col("last_block") >= first) & (F.col("first_block") <= last))
        low, high = held.agg(F.min("block_date"), F.max("block_date")).first()
        if low is None:
            return df.where(F.lit(False))
        df = df.where(F.col(DAY).between(F.lit(low), F.lit(high)))
    return in_block_range(df, first, last)


def run_balances(
    spark: SparkSession, logs: DataFrame, root: str, store: WatermarkStore, chain_id: int, latest: int, start: int = 1, n: int = BLOCKS_PER_BATCH, max_batches: int | None = None,
    days: DataFrame | None = None,
) -> int:
    """Append balance changes of all pending block ranges of ``n`` blocks in one job; returns the number of ranges.

    ``days`` (see :func:`block_days`) prunes logs that are stored by day.
    """
    mark = store.get(chain_id, "incremental/erc20_balances")
    pending = next_block_range(mark.last_block_num if mark else None, latest, start, latest - start + 1 if max_batches is None else n * max_batches)
    if pending is None:
        return 0
    first, last = pending
    mine = in_days_of_blocks(logs.where(F.col("chain_id") == chain_id), days, chain_id, first, last)
    rows = balance_changes_by_range(mine, first, n).withColumn("to_block", F.least("to_block", F.lit(last).cast("bigint")))
    write_of_chain(rows.withColumn("computed_at", F.current_timestamp()), f"{root}/erc20_balance_changes", chain_id)
    store.set(chain_id, "incremental/erc20_balances", "", None, last, mark)
    return -(-(last - first + 1) // n)


def load_specs(folder: str) -> dict[str, str]:
    """SQL metric templates of a folder by file name: adding a file adds a metric."""
    return {p.stem: p.read_text() for p in sorted(Path(folder).glob("*.sql"))}


def run_spec(spark: SparkSession, text: str, chain_id: int, granularity: str, first: datetime, last: datetime) -> DataFrame:
    """One template for a time range: {chain_id} and {granularity} are replaced, the rest is bound."""
    text_of = lambda t: t.strftime("%Y-%m-%d %H:%M:%S.%f")  # noqa: E731  (a zone-free parameter, compared as UTC)
    bound = {"chain_id": chain_id, "first_period": text_of(first), "last_period": text_of(last)}
    return run_sql(spark, text, bound, {"chain_id": chain_id, "granularity": granularity})
