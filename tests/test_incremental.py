"""Runs that go on where earlier ones stopped: carried counts, marks, raw batches, block days, the stored platform cycle."""

import glob
import os
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from blockloom.constants import TRANSFER, USDC_ADDRESS
from blockloom.plans import carried as C
from blockloom.plans import indexer as I
from blockloom.plans import metrics as M
from blockloom.plans import platform as L
from blockloom.plans.status import ChainStatus, stored_sync_status
from blockloom.sources import tables as ST
from blockloom.sources.platform import validator_state
from blockloom.sources.star_schema import Star
from blockloom.streaming import ingest as G
from blockloom.streaming import metrics as T

TRACE = "chain_id bigint, t string, block_number bigint, transaction_index int, `from` binary, `to` binary, tx_success boolean, call_type string"


def address(n):
    return bytes([n]) * 20


def traces(spark, *rows):
    """(time, block, sender) rows of chain 1."""
    data = spark.createDataFrame([(1, t, n, 0, address(f), address(f), True, "CREATE") for t, n, f in rows], TRACE)
    return data.withColumn("block_time", F.to_timestamp("t")).drop("t")


def scan_of(df, spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", 5000)
    plan = df._jdf.queryExecution().executedPlan().toString()
    return next(line for line in plan.splitlines() if "FileScan" in line)


def test_second_of_three_runs_reads_new_days_only(spark, tmp_path):
    root = str(tmp_path)
    ST.write_raw(traces(spark, *[(f"2024-01-{d:02d} 05:00:00", d, d % 4 + 1) for d in range(1, 13)]), root, "raw_traces")
    tables, store = T.raw_views(spark, root), I.WatermarkStore(spark, f"{root}/indexer_watermarks")
    names = ["cumulative_addresses", "cumulative_contracts"]
    reads, plain = [], C.new_rows

    def seen(tables, spec, chain_id, first, end):
        df = plain(tables, spec, chain_id, first, end)
        reads.append((spec.name, sorted({r.d for r in spark.createDataFrame(df.rdd.map(lambda r: (str(r.block_date),)), "d string").distinct().collect()}), scan_of(df, spark)))
        return df

    C.new_rows = seen
    try:
        for latest in (datetime(2024, 1, 5), datetime(2024, 1, 9), datetime(2024, 1, 13)):
            I.run_granular(spark, tables, root, store, 1, latest, names)
    finally:
        C.new_rows = plain
    assert [(n, d[0], d[-1]) for n, d, _ in reads[2:4]] == [(n, "2024-01-05", "2024-01-08") for n in names]
    pruned = reads[2][2].split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "chain_id" in pruned and "block_date" in pruned and ">= 2024-01-05" in pruned
    got = sorted((tuple(r) for r in M.current_metrics(spark.read.parquet(f"{root}/metrics")).where("granularity <> 'month'").select("metric_name", "granularity", "period", "value").collect()), key=repr)
    whole = M.only_complete(M.metric_batch(tables, names, 1), F.lit("2024-01-13").cast("timestamp"))
    assert got == sorted((tuple(r) for r in whole.select("metric_name", "granularity", "period", "value").collect()), key=repr)


def test_broken_run_and_late_rows(spark, tmp_path):
    root = str(tmp_path)
    ST.write_raw(traces(spark, ("2024-01-01 10:00:00", 1, 1), ("2024-01-02 10:00:00", 2, 2), ("2024-01-03 10:00:00", 3, 3)), root, "raw_traces")
    store, names = I.WatermarkStore(spark, f"{root}/indexer_watermarks"), ["cumulative_addresses", "cumulative_contracts"]
    values = lambda: {(r.metric_name, r.period.day): int(r.value) for r in M.current_metrics(spark.read.parquet(f"{root}/metrics")).where("granularity = 'day'").collect()}
    C.advance(spark, T.raw_views(spark, root), root, 1, names, None, datetime(2024, 1, 2, 12))  # a run that broke off without its marks
    I.run_granular(spark, T.raw_views(spark, root), root, store, 1, datetime(2024, 1, 4, 1), names, grains=("day",))
    assert values() == {(n, d): d for n in names for d in (1, 2, 3)}
    ST.write_raw(traces(spark, ("2024-01-01 11:00:00", 9, 3), ("2024-01-01 11:00:00", 9, 4)), root, "raw_traces")  # 3 appears earlier now
    for _ in range(2):
        late = datetime(2024, 1, 1, 11)
        T.recompute_late(spark, root, 1, late, late, names)
        assert values() == {("cumulative_addresses", 1): 3, ("cumulative_addresses", 2): 4, ("cumulative_addresses", 3): 4, **{("cumulative_contracts", d): d + 2 for d in (1, 2, 3)}}
    ends = M.current_metrics(spark.read.parquet(f"{root}/metrics")).where("granularity = 'day'").agg(F.max("period").alias("p")).first().p
    assert ends.day == 3  # nothing beyond the mark


def test_first_seen_costs_what_the_batch_does(spark, tmp_path):
    path = str(tmp_path / "seen")
    store = C.FirstSeen(spark, path, 16)
    rows = lambda n, day: spark.createDataFrame([(1, i.to_bytes(20, "big"), day) for i in n], "chain_id bigint, address binary, d string").select("chain_id", "address", F.to_timestamp("d").alias("first_seen"))
    assert store.add(rows(range(1, 400), "2024-01-05")).where("later").count() == 399
    before = set(glob.glob(f"{path}/**/*.parquet", recursive=True))
    seen = store.add(rows([7, 1000], "2024-01-06")).collect()
    assert sorted((r.later, r.first_seen.day) for r in seen) == [(False, 5), (True, 6)]
    added = set(glob.glob(f"{path}/**/*.parquet", recursive=True)) - before
    assert len(added) == 1 and len({os.path.dirname(f) for f in before}) == 16
    known = store.known([1], [3])
    assert "bucket" in scan_of(known, spark).split("PartitionFilters")[1].split("PushedFilters")[0]
    assert store.add(rows([1000], "2024-01-06")).where("later").count() == 0
    assert store.add(rows([1000], "2024-01-02")).where("later").count() == 1
    assert {bytes(r.address): r.first_seen.day for r in store.read().where("first_seen < '2024-01-05'").collect()} == {(1000).to_bytes(20, "big"): 2}
    with pytest.raises(ValueError, match="buckets"):
        C.FirstSeen(spark, path, 8).read()
    assert store.add(rows([], "2024-01-02")).count() == 0


def test_first_seen_stream_restarts(spark, star, tmp_path):
    src, path, cp = str(tmp_path / "in"), str(tmp_path / "seen"), str(tmp_path / "cp")
    data = star.raw_traces().select("chain_id", "block_time", "from", "to")
    schema = data.schema
    halves = [data.where("block_time >= timestamp '2024-01-10'"), data.where("block_time < timestamp '2024-01-10'")]
    for half in halves:  # the stream ends after each half and starts again from its checkpoint
        half.coalesce(1).write.mode("append").parquet(src)
        T.start_first_seen(spark.readStream.schema(schema).parquet(src), path, cp, buckets=4, once=True).awaitTermination()
    T.start_first_seen(spark.readStream.schema(schema).parquet(src), path, str(tmp_path / "other"), buckets=4, once=True).awaitTermination()  # everything once more
    got = {(r.chain_id, bytes(r.address)): r.first_seen for r in T.read_first_seen(spark, path, 4).collect()}
    want = {(r.chain_id, bytes(r.address)): r.first_seen for r in M.first_seen(star.raw_traces(), ("from", "to"), "block_time").collect()}
    assert got == want
    assert spark.read.parquet(path).count() < 1.5 * len(want)


@pytest.fixture(scope="module")
def star(spark, folder):
    return Star(spark, folder)


def test_marks_of_two_writers_merge_by_their_maximum(spark, tmp_path):
    path = str(tmp_path / "marks")
    stores = [I.WatermarkStore(spark, path) for _ in range(2)]
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda n: stores[n % 2].set(1, "a", "day", datetime(2024, 1, n), n), [3, 9, 5, 2]))
    assert len(glob.glob(f"{path}/*/*.parquet")) == 4
    mark = stores[0].get(1, "a", "day")
    assert (mark.last_period, mark.last_block_num) == (datetime(2024, 1, 9), 9)
    stores[0].set_all(2, {("x", ""): I.Watermark(None, 0), ("y", "hour"): I.Watermark(datetime(2024, 1, 1), None)})
    assert len(glob.glob(f"{path}/*/*.parquet")) == 5
    assert stores[1].get(2, "x").last_block_num == 0 and I.next_block_range(0, 5) == (1, 5)
    stores[0].reset(1)
    stores[1].set(2, "x", "", None, 4)
    assert stores[1].get(1, "a", "day").last_period is None and stores[1].get(2, "x").last_block_num == 4
    stores[1].set(1, "a", "day", datetime(2024, 1, 1), 1)
    assert stores[0].get(1, "a", "day").last_block_num == 1


def test_marks_are_read_and_appended_once_a_run(spark, star, tmp_path):
    root = str(tmp_path)
    store = I.WatermarkStore(spark, f"{root}/marks")
    reads, table = [], store.table
    store.table = lambda: reads.append(1) or table()
    I.run_granular(spark, {"raw_traces": star.raw_traces()}, root, store, 1, datetime(2024, 1, 9), ["contracts", "deployers", "cumulative_contracts"])
    assert len(reads) == 1 and len(glob.glob(f"{root}/marks/*/*.parquet")) == 1


def nested(spark, star, low, high):
    number = F.conv(F.substring("block.number", 3, 16), 16, 10).cast("bigint")
    return star.nested_events().where(number.between(low, high))


def test_broken_batch_is_whole_after_its_repeat(spark, star, tmp_path):
    root = str(tmp_path)
    G.write_batch(nested(spark, star, 0, 49), root, 9, batch="s-0")
    counts = lambda: {t: ST.read_table(spark, root, t).count() for t in ST.RAW_LAYOUT}
    G.write_batch(nested(spark, star, 50, 99), root, 9, batch="s-1")
    whole, mark = counts(), I.WatermarkStore(spark, f"{root}/sync_watermark").sync_get(9)
    assert mark == 99
    files = sorted(glob.glob(f"{root}/raw_traces/**/batch=s-1/*.parquet", recursive=True))
    rows = spark.read.parquet(files[0])
    half = rows.limit(max(1, rows.count() // 2)).toPandas()  # the file of a write that broke within a block
    import pyarrow as pa
    import pyarrow.parquet as pq

    pq.write_table(pa.Table.from_pandas(half[["block_number"]]), files[0])
    for crc in glob.glob(f"{os.path.dirname(files[0])}/.*.crc"):
        os.truncate(crc, 0)
        os.unlink(crc)
    G.write_batch(nested(spark, star, 50, 99), root, 9, batch="s-1")
    assert counts() == whole
    G.write_batch(nested(spark, star, 40, 60), root, 9, batch="other-0")  # another stream delivers stored blocks again
    assert counts() == whole
    G.write_batch(nested(spark, star, 90, 110), root, 9)
    assert counts()["raw_blocks"] == whole["raw_blocks"] + 11
    held = ST.stored_blocks(spark, root, "raw_txs", 9, datetime(2024, 1, 1).date(), datetime(2024, 1, 2).date(), "s-1")
    pruned = scan_of(held, spark).split("PartitionFilters")[1].split("PushedFilters")[0]
    assert all(c in pruned for c in ("chain_id", "block_date", "batch"))
    days = I.block_days(spark, root).agg(F.min("first_block"), F.max("last_block")).first()
    assert tuple(days) == (0, 110)


def test_block_days_prune_ranges(spark, tmp_path):
    root = str(tmp_path)
    rows = [(1, f"2024-01-{d:02d} 0{h}:00:00", d * 1000 + h) for d in range(1, 8) for h in range(3)]
    logs = spark.createDataFrame(rows, "chain_id bigint, t string, block_number bigint").withColumn("block_time", F.to_timestamp("t")).drop("t")
    word = F.unhex(F.lit("00" * 31 + "05"))
    logs = logs.withColumns({"address": F.lit(address(1)), "topic0": F.unhex(F.lit(TRANSFER.removeprefix("0x"))), "topic1": F.unhex(F.lit("00" * 12 + "02" * 20)), "topic2": F.unhex(F.lit("00" * 12 + "03" * 20)), "data": word})
    ST.write_raw(logs, root, "raw_logs")
    for part in ("block_number < 3001", "block_number >= 2001"):  # overlapping batches in any order
        I.write_block_days(logs.where(part), root)
    days, stored = I.block_days(spark, root), ST.read_table(spark, root, "raw_logs")
    assert {(str(r.block_date), r.first_block, r.last_block) for r in days.collect()} == {(f"2024-01-{d:02d}", d * 1000, d * 1000 + 2) for d in range(1, 8)}
    some = I.in_days_of_blocks(stored, days, 1, 2001, 4500)
    pruned = scan_of(some, spark).split("PartitionFilters")[1].split("PushedFilters")[0]
    assert ">= 2024-01-02" in pruned and "<= 2024-01-04" in pruned and some.count() == 8
    assert I.in_days_of_blocks(stored, days, 1, 9000, 9999).count() == 0
    store = I.WatermarkStore(spark, f"{root}/marks")
    assert I.run_balances(spark, stored, root, store, 1, 4002, start=0, days=days) == 3
    assert I.run_balances(spark, stored, root, store, 1, 4002, start=0, days=days) == 0
    assert I.run_balances(spark, stored, root, store, 1, 7002, start=0, days=days, max_batches=1) == 1
    changes = spark.read.parquet(f"{root}/erc20_balance_changes")
    assert {(r.from_block, r.to_block) for r in changes.collect()} == {(0, 1999), (2000, 3999), (4000, 4002), (4003, 6002)}


def test_range_that_grows_counts_once(spark, star, tmp_path):
    from blockloom.plans import balances as B

    root, logs = str(tmp_path), star.token_logs().where("chain_id = 1")
    top = logs.agg(F.max("block_number").alias("n")).first().n
    I.run_balances(spark, logs, root, I.WatermarkStore(spark, f"{root}/lost"), 1, top // 3, start=0)  # its mark is lost
    I.run_balances(spark, logs, root, I.WatermarkStore(spark, f"{root}/marks"), 1, top, start=0)
    key = lambda df: sorted((bytes(r.wallet), bytes(r.token), bytes(r.total_in), bytes(r.total_out)) for r in df.collect())
    assert key(B.balances(spark.read.parquet(f"{root}/erc20_balance_changes"))) == key(B.balances(B.balance_changes(logs, 0, top)))


def test_huge_volume_does_not_stop_a_run(spark, tmp_path):
    amounts = [(2**256 - 1).to_bytes(32, "big"), (5 * 10**6).to_bytes(32, "big")]
    rows = [(1, bytes.fromhex(USDC_ADDRESS.removeprefix("0x")), bytes.fromhex(TRANSFER.removeprefix("0x")), n, f"2024-01-03 0{i}:10:00") for i, n in enumerate(amounts)]
    logs = spark.createDataFrame(rows, "chain_id bigint, address binary, topic0 binary, data binary, at string").withColumn("block_time", F.to_timestamp("at")).drop("at")
    hours = {r.period.hour: r.value for r in M.metric_batch({"raw_logs": logs}, ["usdc_volume"], grains=("hour",)).collect()}
    assert hours[0] is None and int(hours[1]) == 5
    assert [r.value for r in M.metric("usdc_volume", "day", {"raw_logs": logs}).collect()] == [None]
    assert I.run_granular(spark, {"raw_logs": logs}, str(tmp_path), I.WatermarkStore(spark, f"{tmp_path}/marks"), 1, datetime(2024, 1, 5), ["usdc_volume", "icm_total"], grains=("day",)) == 1


def test_purge_resets_marks_and_status(spark, star, tmp_path):
    root = str(tmp_path)
    status, marks, indexers = ChainStatus(spark, f"{root}/chain_status"), I.WatermarkStore(spark, f"{root}/sync_watermark"), I.WatermarkStore(spark, f"{root}/indexer_watermarks")
    for chain in (1, 2):
        status.upsert(chain, f"c{chain}", 100)
        marks.sync_set(chain, 80)
        indexers.set_all(chain, {("evm_metrics/tx_count", g): I.Watermark(datetime(2024, 1, 1), None) for g in ("hour", "day")})
    status.upsert(2, "c2", 160)
    assert {(r.chain_id, r.blocks_behind, r.sync_percentage) for r in stored_sync_status(spark, root).collect()} == {(1, 20, 80.0), (2, 80, 50.0)}
    ST.purge_chain(spark, root, 1, marks=[marks, indexers], status=status)
    assert [r.chain_id for r in stored_sync_status(spark, root).collect()] == [2]
    assert marks.resume_at(1) == 1 and all(m.last_period is None for m in indexers.marks(1).values()) and len(indexers.marks(2)) == 2
    status.upsert(1, "again", 5)
    assert {(r.name, r.watermark_block) for r in stored_sync_status(spark, root).collect()} == {("again", None), ("c2", 80)}
    assert "chain_status" not in ST.drop_derived(spark, root)


def test_stored_cycles_keep_differences_only(spark, star, tmp_path):
    root = str(tmp_path)
    snapshot = lambda t: validator_state(star.snapshot(), 0, F.lit(t).cast("timestamp"))
    run = lambda snap, t: L.store_platform_cycle(spark, root, star.platform_txs(), snap, star.registrations(), t)
    sizes = lambda: {n: L.platform_versions(spark, root, n).count() for n in L.PLATFORM_TABLES}
    run(snapshot("2001-08-01"), "2001-08-01")
    first = sizes()
    assert all(first.values())
    run(snapshot("2001-08-02"), "2001-08-02")
    assert sizes() == first  # nothing differs
    one = F.col("subnet_id") == "subnet3"
    renamed = snapshot("2001-08-03").withColumn("validation_id", F.when(one, F.lit("other")).otherwise(F.col("validation_id")))
    state = lambda tables: {r.validation_id: r.active for r in tables["l1_validator_state"].where(one).collect()}
    before = {r.validation_id: r.active for r in snapshot("x").select("validation_id", "active", "subnet_id").where(one).collect()}
    (old,) = before
    assert before[old] is True
    assert state(run(renamed, "2001-08-03")) == {old: False, "other": True}
    assert sizes()["l1_validator_state"] == first["l1_validator_state"] + 2
    assert state(run(snapshot("2001-08-04"), "2001-08-04")) == {old: True, "other": False}


def numbers(spark, root):
    return sorted(r.block_number for r in ST.read_table(spark, root, "raw_traces").collect())


def small_batches(spark, root, n):
    days = ("2024-01-01", "2024-01-02", "2024-01-03")
    for i in range(n):
        ST.write_raw(traces(spark, *[(f"{d} 05:00:00", 100 * i + j, 1) for j, d in enumerate(days)]), root, "raw_traces", "stream", batch=f"b{i}")


def test_closed_days_are_merged(spark, tmp_path):
    root = str(tmp_path)
    assert ST.merge_days(spark, root, "raw_traces", 1, date(2024, 1, 3)) == []
    small_batches(spark, root, 12)
    before = numbers(spark, root)
    assert ST.merge_days(spark, root, "raw_traces", 1, date(2024, 1, 3)) == ["2024-01-01", "2024-01-02"]
    files = {r.day: r["count"] for r in ST.batch_files(spark, root, "raw_traces", 1).groupBy("day").count().collect()}
    assert files == {"2024-01-01": 1, "2024-01-02": 1, "2024-01-03": 12} and numbers(spark, root) == before
    assert ST.merge_days(spark, root, "raw_traces", 1, date(2024, 1, 3)) == []
    known = ST.stored_blocks(spark, root, "raw_traces", 1, F.lit("2024-01-01").cast("date"), F.lit("2024-01-03").cast("date"), "b3")
    ST.write_new(traces(spark, ("2024-01-01 05:00:00", 300, 1), ("2024-01-02 05:00:00", 301, 1)), root, "raw_traces", "b3", known)  # comes again
    assert numbers(spark, root) == before
    assert len(glob.glob(f"{root}/_merging/*/*")) == 0
    # bytes decide: a day of one needed file for each row has none too many
    assert ST.merge_days(spark, root, "raw_traces", 1, date(2024, 1, 4), target_bytes=1) == []


def test_broken_merge_is_completed(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    small_batches(spark, root, 6)
    before = numbers(spark, root)
    change, gone = ST._change_over, []

    def once(spark, home, staged):
        if os.path.exists(f"{staged}/rows"):
            raise RuntimeError("lost")
        change(spark, home, staged)

    def breaks(spark, path):  # lost among the deletions of the first day
        if len(gone) == 3:
            raise RuntimeError("lost")
        gone.append(path)
        return delete(spark, path)

    delete = ST.delete_path
    monkeypatch.setattr(ST, "_change_over", once)
    with pytest.raises(RuntimeError):
        ST.merge_days(spark, root, "raw_traces", 1, date(2024, 1, 3))
    assert numbers(spark, root) == before
    monkeypatch.setattr(ST, "_change_over", change)
    monkeypatch.setattr(ST, "delete_path", breaks)
    with pytest.raises(RuntimeError):
        ST.merge_days(spark, root, "raw_traces", 1, date(2024, 1, 3))
    monkeypatch.setattr(ST, "delete_path", delete)
    ST.write_raw(traces(spark, ("2024-01-01 06:00:00", 999, 1)), root, "raw_traces", "stream", batch="late")
    assert ST.merge_days(spark, root, "raw_traces", 1, date(2024, 1, 3)) == []
    assert numbers(spark, root) == [*before, 999]
    assert {r.batch[:6] for r in ST.batch_files(spark, root, "raw_traces", 1).where("day = '2024-01-01'").collect()} == {"merged", "late"}


def test_months_in_state(spark, tmp_path):
    """Batches of a stream that ends and starts again; a month comes when it has ended, without its raw rows being read again."""
    src, out, cp = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    schema = "chain_id bigint, block_time timestamp, gas bigint, `from` binary"
    specs = [M.MetricSpec(k, "raw_txs", k, None if k == "count" else lambda: F.col("gas"), keys=("from",)) for k in ("count", "sum", "max", "avg", "rate", "distinct")]

    def feed(*rows):
        data = spark.createDataFrame([(*r, address(r[2] % 9 + 1)) for r in rows], "chain_id bigint, t string, gas bigint, `from` binary").withColumn("block_time", F.to_timestamp("t"))
        data.select("chain_id", "block_time", "gas", "from").coalesce(1).write.mode("append").parquet(src)
        got = {}
        for spec in specs:
            months = T.stream_metric(spark.readStream.schema(schema).parquet(src), spec, "month")
            sink = months.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{cp}/{spec.name}").option("path", f"{out}/{spec.name}")
            sink.trigger(availableNow=True).start().awaitTermination()
            rows = spark.read.schema(months.schema).parquet(f"{out}/{spec.name}").collect()
            got |= {(r.metric_name, r.chain_id, r.period.month): int(r.value) for r in rows}
            assert all((r.granularity, r.period.day, r.period.hour) == ("month", 1, 0) for r in rows)
        return got

    big = 5_000_000
    assert feed((1, "2024-01-03 01:00:00", 5 * big), (1, "2024-01-03 01:00:00", 8 * big), (2, "2024-01-20 00:00:00", 3)) == {}
    assert feed((1, "2024-01-31 23:59:59", 1)) == {}
    total = 13 * big + 1
    first = {
        ("count", 1, 1): 3, ("sum", 1, 1): total, ("max", 1, 1): 8 * big, ("avg", 1, 1): total // 3, ("rate", 1, 1): total // (31 * 86400), ("distinct", 1, 1): 3,
        ("count", 2, 1): 1, ("sum", 2, 1): 3, ("max", 2, 1): 3, ("avg", 2, 1): 3, ("rate", 2, 1): 0, ("distinct", 2, 1): 1,
    }
    assert feed((1, "2024-02-01 00:00:00", 7)) == first  # chain 2 has no row in February
    whole = feed((1, "2024-01-05 00:00:00", 100), (1, "2024-02-29 23:59:59", 9), (2, "2024-12-31 12:00:00", 4), (1, "2024-12-02 00:00:00", 6))
    assert {k: v for k, v in whole.items() if k[2] == 1} == first  # what comes late is dropped
    assert {k: v for k, v in whole.items() if k[2] > 1 and k[0] in ("sum", "avg")} == {("sum", 1, 2): 16, ("avg", 1, 2): 8}
    with pytest.raises(ValueError, match="months"):
        T.stream_metric(spark.readStream.schema(schema).parquet(src), "max_tps", "month")


def test_stored_blocks_never_pass_through_the_driver(spark, star, tmp_path):
    from blockloom.operators.versioned import only_new

    root = str(tmp_path)
    G.write_batch(nested(spark, star, 0, 99), root, 9, batch="s-0")
    held = ST.stored_blocks(spark, root, "raw_blocks", 9, datetime(2024, 1, 1).date(), datetime(2024, 12, 31).date(), "s-1")
    fresh = only_new(ST.read_table(spark, root, "raw_blocks"), held, ["chain_id", "block_number"])
    assert "Broadcast" not in fresh._jdf.queryExecution().executedPlan().toString() and fresh.count() == 0
