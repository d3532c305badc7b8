from datetime import datetime

import pytest
from pyspark.sql import functions as F

from blockloom.plans import balances as B
from blockloom.plans import indexer as I
from blockloom.plans import metrics as M
from blockloom.plans import platform as L
from blockloom.sources.platform import read_registry, read_validator_snapshot
from blockloom.sources.star_schema import Star
from blockloom.streaming import metrics as T


@pytest.fixture(scope="module")
def star(spark, folder):
    return Star(spark, folder)


def _rows(df):
    return sorted((tuple(r) for r in df.select(*M.SERIES).collect()), key=repr)


def test_batch_equals_single_metrics(star):
    tables = {"raw_txs": star.raw_txs(), "raw_blocks": star.raw_blocks(), "raw_traces": star.raw_traces(), "raw_logs": star.message_logs()}
    names = ["avg_tps", "max_gps", "avg_gas_price", "active_addresses", "icm_total", "usdc_volume", "cumulative_deployers"]
    batch = M.metric_batch(tables, names, grains=("week", "month"))
    single = [r for n in names for g in ("week", "month") for r in _rows(M.metric(n, g, tables))]
    assert _rows(batch) == sorted(single, key=repr)


def test_token_volume_of_huge_transfers(spark):
    amounts = [2**256 - 1, 2**256 - 1, 10**45, 7 * 10**6, 3]
    rows = [(1, bytes.fromhex(f"{7:040x}"), bytes.fromhex(M.TRANSFER.removeprefix("0x")), n.to_bytes(32, "big"), f"2024-01-03 0{i}:10:00") for i, n in enumerate(amounts)]
    logs = spark.createDataFrame(rows, "chain_id int, address binary, topic0 binary, data binary, at string").withColumn("block_time", F.to_timestamp("at"))
    spec = M.MetricSpec("token_7", "raw_logs", "token_volume", token=f"{7:040x}", decimals=6)
    want = str(sum(amounts) // 10**6)
    assert [r.value for r in M.token_volume(logs, None, 6, "day").collect()] == [want]
    batch = {(r.granularity, r.period.hour): r.value for r in M.token_volume_batch(logs, spec, ("hour", "week")).collect()}
    assert batch["week", 0] == want and [batch["hour", i] for i in range(5)] == [str(n // 10**6) for n in amounts]


def test_series_of_huge_volumes(spark):
    """The stable coin's series: exact text on demand, null where a decimal cannot hold it, and every other metric alike."""
    amounts = [2**256 - 1, 10**45, 7 * 10**6, 10**44 - 1]
    coin, transfer = bytes.fromhex(M.USDC_ADDRESS.removeprefix("0x")), bytes.fromhex(M.TRANSFER.removeprefix("0x"))
    rows = [(1, coin, transfer, n.to_bytes(32, "big"), f"2024-01-03 0{i}:10:00") for i, n in enumerate(amounts)]
    logs = spark.createDataFrame(rows, "chain_id bigint, address binary, topic0 binary, data binary, at string").withColumn("block_time", F.to_timestamp("at"))
    names = ["usdc_volume", "icm_total"]
    text = {(r.metric_name, r.granularity, r.period.hour): r.value for r in M.metric_batch({"raw_logs": logs}, names, grains=("hour", "day"), exact=True).collect()}
    assert [text["usdc_volume", "hour", i] for i in range(4)] == [str(n // 10**6) for n in amounts] and text["usdc_volume", "day", 0] == str(sum(amounts) // 10**6)
    plain = {(r.metric_name, r.granularity, r.period.hour): r.value for r in M.metric_batch({"raw_logs": logs}, names, grains=("hour", "day")).collect()}
    assert set(plain) == set(text) and all(str(v) == text[k] if v is not None else len(text[k]) > 38 for k, v in plain.items())
    assert [plain["usdc_volume", "hour", i] is None for i in range(4)] == [True, True, False, False]
    for n in names:
        for g in ("hour", "day"):
            single = {(r.metric_name, r.granularity, r.period.hour): r.value for r in M.metric(n, g, {"raw_logs": logs}, exact=True).collect()}
            assert single == {k: v for k, v in text.items() if k[:2] == (n, g)}


def test_granularities_agree(star):
    series = M.metric_batch({"raw_txs": star.raw_txs()}, ["tx_count"])
    totals = series.groupBy("granularity").agg(F.sum("value").alias("n")).collect()
    assert len(totals) == 4 and {int(r.n) for r in totals} == {star.raw_txs().count()}


def test_cumulative_in_slices_equals_one_run(star):
    tables = {"raw_traces": star.raw_traces()}
    at = lambda t: F.lit(t).cast("timestamp")
    whole = _rows(M.metric("cumulative_addresses", "day", tables))
    cuts = [None, "2024-01-06", "2024-01-07", "2024-01-20", None]
    parts = []
    for a, b in zip(cuts, cuts[1:]):
        parts += _rows(M.metric("cumulative_addresses", "day", tables, None, at(a) if a else None, at(b) if b else None))
    assert sorted(parts, key=repr) == whole


def test_total_in_equals_total_out_over_transfers(star):
    """Every transfer leaves one wallet and enters another, the zero address included."""
    from blockloom.constants import TRANSFER
    from blockloom.functions.u256 import u256_sum
    from blockloom.operators.filters import with_signature

    entries = B.token_entries(with_signature(star.token_logs(), [TRANSFER]))
    sums = entries.agg(u256_sum("amount", F.col("incoming")).alias("i"), u256_sum("amount", ~F.col("incoming")).alias("o")).first()
    zero_out = star.token_logs().where("hex(topic1) = repeat('0', 64)").count()
    assert zero_out > 0 and bytes(sums.i) > bytes(sums.o)  # senders at the zero address are left out


def test_block_ranges():
    assert I.next_block_range(None, 5000) == (1, 2000) and I.next_block_range(2000, 5000) == (2001, 4000)
    assert I.next_block_range(4000, 5000) == (4001, 5000) and I.next_block_range(5000, 5000) is None


def test_watermarks(spark, tmp_path):
    store = I.WatermarkStore(spark, str(tmp_path / "marks"))
    assert store.get(1, "a") is None and store.resume_at(1) == 1
    for n in (5, 6, 7):
        store.set(1, "a", "day", datetime(2024, 1, n), n)
    store.sync_set(1, 41)
    mark = store.get(1, "a", "day")
    assert (mark.last_period, mark.last_block_num) == (datetime(2024, 1, 7), 7) and store.resume_at(1) == 42 and store.get(1, "a") is None


def _platform(spark, rows):
    df = spark.createDataFrame(rows, "tx_id string, tx_type string, block_number bigint, t string, body string")
    return df.select("tx_id", "tx_type", "block_number", F.col("t").cast("timestamp").alias("block_time"), F.lit(0).cast("bigint").alias("p_chain_id"), F.parse_json("body").alias("tx_data"))


def test_refund_spans(spark):
    convert = '{"subnetID":"s","chainID":"c","validators":[{"nodeID":"n","validationID":"v","weight":1,"balance":1000000,"remainingBalanceOwner":{"addresses":["P-1"]}}]}'
    up = '{"validationID":"v","balance":%d}'
    off = '{"validationID":"v"}'
    txs = _platform(
        spark,
        [
            ("t1", "ConvertSubnetToL1", 1, "2024-01-01 00:00:00", convert),
            ("t2", "IncreaseL1ValidatorBalance", 2, "2024-01-01 00:00:10", up % 7),
            ("t3", "DisableL1Validator", 3, "2024-01-01 00:00:10", off),
            ("t4", "IncreaseL1ValidatorBalance", 4, "2024-01-01 00:00:10", up % 500000),
            ("t5", "IncreaseL1ValidatorBalance", 5, "2024-01-01 00:01:00", up % 60000),
            ("t6", "DisableL1Validator", 6, "2024-01-01 00:01:40", off),
            ("t7", "DisableL1Validator", 7, "2024-01-01 00:02:00", off),
        ],
    )
    history = L.validator_history(txs, None, "2024-01-02")
    state = spark.createDataFrame([("s", "v", "n")], "subnet_id string, validation_id string, node_id string").selectExpr(
        "*", "cast(0 as bigint) p_chain_id", "timestamp '2020-01-01' start_time"
    )
    ledger = L.balance_ledger(txs, state, history)
    out = {r.tx_id: int(r.refund_amount) for r in L.refunds(txs, ledger, history, state).collect()}
    # first span counts everything up to its end, the deposits at that very second too; the second only what came later; the third had none
    assert out == {"t3": 1000000 + 7 + 500000 - 10 * 512, "t6": 60000 - 90 * 512}


def test_subnet_lifecycle(spark):
    txs = _platform(
        spark,
        [
            ("a", "CreateChain", 1, "2024-01-01", '{"subnetID":"s1","chainName":"one","vmID":"vm"}'),
            ("b", "TransformSubnet", 5, "2024-01-02", '{"subnetID":"s1"}'),
            ("c", "ConvertSubnetToL1", 9, "2024-01-03", '{"subnetID":"s1","chainID":"c1"}'),
            ("d", "AddSubnetValidator", 2, "2024-01-01", '{"subnetID":"s2"}'),
            ("e", "TransformSubnet", 3, "2024-01-01", '{"subnetID":"s3"}'),
            ("f", "CreateChain", 4, "2024-01-01", '{"subnetID":""}'),
        ],
    )
    out = {r.subnet_id: (r.subnet_type, r.created_block, r.converted_block, r.chain_id) for r in L.all_subnets(txs, "2024-02-01").collect()}
    assert out == {"s1": ("l1", 1, 9, "c1"), "s2": ("regular", 2, 0, ""), "s3": ("elastic", 3, 3, "")}
    assert [(r.chain_id, r.chain_name, r.created_block) for r in L.subnet_chains(txs, "2024-02-01").collect()] == [("c1", "one", 1)]
    assert {r.subnet_id: r.chain_id for r in L.subnet_conversions(txs, "2024-02-01").collect()} == {"s1": "c1", "s3": ""}


def test_registry_and_snapshot_files(spark, tmp_path):
    for name, text in (("a", '{"subnetId":"s1",\n"name":"One"}'), ("b/c", '{"subnetId":"","name":"None"}')):
        (tmp_path / "data" / name).mkdir(parents=True)
        (tmp_path / "data" / name / "chain.json").write_text(text)
        (tmp_path / "data" / name / "other.json").write_text('{"subnetId":"x"}')
    assert [(r.subnet_id, r.name, r.website_url) for r in read_registry(spark, str(tmp_path / "data")).collect()] == [("s1", "One", "")]
    (tmp_path / "v.json").write_text(
        '{"subnetID":"s","txID":"t1","weight":"5","nodeID":"n1","startTime":"10"}\n'
        '{"subnetID":"s","txID":"t2","weight":"bad","nodeID":"n2","validationID":"v2","balance":"0"}\n'
        '{"subnetID":"s","txID":"t3","weight":"7","nodeID":"n3","validationID":"v3","balance":"9","uptime":"99.5"}\n'
    )
    rows = {r.validation_id: (int(r.weight), r.active, r.uptime_percentage) for r in read_validator_snapshot(spark, str(tmp_path / "v.json")).collect()}
    assert rows == {"t1": (5, True, 0.0), "v2": (0, False, 0.0), "v3": (7, True, 99.5)}


def test_late_rows_are_dropped_by_the_stream_and_counted_by_recomputing(spark, star, tmp_path):
    schema = "chain_id bigint, block_time timestamp"
    rows = lambda *times: spark.createDataFrame([(1, t) for t in times], "chain_id bigint, t string").select("chain_id", F.col("t").cast("timestamp").alias("block_time"))
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    stream = T.stream_metric(_source(spark, src, schema), M.MetricSpec("n", "x", "count"), "hour")
    for batch in (["2024-01-01 10:05:00", "2024-01-01 12:01:00"], ["2024-01-01 10:30:00", "2024-01-01 14:00:00"]):
        rows(*batch).write.mode("append").parquet(src)
        q = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).option("path", out).trigger(availableNow=True).start()
        q.awaitTermination()
    got = {r.h: int(r.value) for r in spark.read.parquet(out).select(F.hour("period").alias("h"), "value").collect()}
    assert got == {10: 1, 12: 1}
    root = str(tmp_path / "root")
    blocks = rows("2024-01-01 10:05:00", "2024-01-01 10:30:00").withColumns({"gas_used": F.lit(1), "block_number": F.lit(1)})
    from blockloom.sources.tables import write_raw

    write_raw(blocks, root, "raw_blocks")
    T.recompute_late(spark, root, 1, datetime(2024, 1, 1, 10, 30), datetime(2024, 1, 1, 10, 30), ["max_gps"])
    fixed = M.current_metrics(spark.read.parquet(f"{root}/metrics")).where("granularity = 'hour'").collect()
    assert [(r.metric_name, int(r.value)) for r in fixed] == [("max_gps", 1)]


def _source(spark, path, schema):
    import os

    os.makedirs(path, exist_ok=True)
    return spark.readStream.schema(schema).parquet(path)


def test_filters_and_columns_reach_the_scan(spark, star, tmp_path):
    from blockloom.sources.tables import read_table, write_raw

    write_raw(star.raw_traces(), str(tmp_path), "raw_traces")
    stored = read_table(spark, str(tmp_path), "raw_traces")
    df = M.metric("contracts", "day", {"raw_traces": stored}, 2, F.lit("2024-01-05").cast("timestamp"))
    spark.conf.set("spark.sql.maxMetadataStringLength", 5000)
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    pruned = scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "chain_id" in pruned and "block_date" in pruned and ">= 2024-01-05" in pruned
    assert "In(call_type" in scan and "GreaterThanOrEqual(block_time" in scan and "EqualTo(tx_success,true)" in scan
    assert "ReadSchema: struct<block_time:timestamp,call_type:string,tx_success:boolean>" in scan
    assert df.count() > 0


@pytest.mark.parametrize("name", ["gas_used", "avg_gas_price", "max_gas_price", "avg_tps", "max_tps"])
def test_stream_equals_batch_for_closed_days(spark, folder, star, tmp_path, name):
    from blockloom.sources.star_schema import StreamStar

    stream = T.stream_metric(StreamStar(spark, folder).raw_txs(), name, "day")
    sink = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).option("path", str(tmp_path / "out"))
    sink.trigger(availableNow=True).start().awaitTermination()
    got = _rows(spark.read.schema(stream.schema).parquet(str(tmp_path / "out")))
    latest = star.raw_txs().agg(F.max("block_time")).scalar()
    want = _rows(M.only_complete(M.metric(name, "day", {"raw_txs": star.raw_txs()}), latest))
    assert got == want and len(got) > 100


def test_empty_snapshot_deactivates_nobody(spark, star):
    from blockloom.sources.platform import validator_state

    state = validator_state(star.snapshot(), 0, F.lit("2024-01-01").cast("timestamp"))
    assert L.mark_inactive(state, state.where("false"), "2024-01-02").count() == 0
    one = state.where("subnet_id = 'subnet1'").withColumn("validation_id", F.lit("another"))
    gone = L.mark_inactive(state, one, "2024-01-02").collect()
    assert {r.subnet_id for r in gone} <= {"subnet1"} and not any(r.active for r in gone)


def test_search_text_routes():
    from blockloom.plans.dashboards import lookup

    assert lookup(" 42 ") == ("block", 42) and lookup("4x") == ("tx", "4x")


def test_late_rows_raise_all_later_cumulative_values(spark, tmp_path):
    from blockloom.sources.tables import write_raw

    root, a, b, c = str(tmp_path), bytes([1] * 20), bytes([2] * 20), bytes([3] * 20)

    def write(*rows):
        data = spark.createDataFrame([(1, t, n, 0, f, f, True, "CALL") for t, n, f in rows], "chain_id bigint, t string, block_number bigint, transaction_index int, `from` binary, `to` binary, tx_success boolean, call_type string")
        write_raw(data.withColumn("block_time", F.to_timestamp("t")).withColumn("block_date", F.to_date("block_time")).drop("t"), root, "raw_traces")

    write(("2024-01-01 10:00:00", 1, a), ("2024-01-02 10:00:00", 2, b), ("2024-01-03 10:00:00", 3, a))
    write_series = M.metric_batch(T.raw_views(spark, root), ["cumulative_addresses"], 1, grains=("day",)).withColumn("computed_at", F.to_timestamp(F.lit("2024-01-04")))
    write_series.write.partitionBy("chain_id", "granularity").parquet(f"{root}/metrics")
    write(("2024-01-01 11:00:00", 4, b), ("2024-01-01 11:00:00", 4, c))  # what was new on the second day is now of the first
    late = datetime(2024, 1, 1, 11)
    T.recompute_late(spark, root, 1, late, late, ["cumulative_addresses"])
    days = M.current_metrics(spark.read.parquet(f"{root}/metrics")).where("granularity = 'day'").orderBy("period").collect()
    assert [int(r.value) for r in days] == [3, 3]


def test_cumulative_from_stored_values_takes_the_newest(spark):
    rows = [(1, "tx_count", "day", d, v, at) for d, v, at in (("2024-01-01", 9, 1), ("2024-01-01", 10, 2), ("2024-01-02", 5, 1))]
    stored = spark.createDataFrame(rows, "chain_id bigint, metric_name string, granularity string, d string, value bigint, at bigint")
    stored = stored.withColumns({"period": F.to_timestamp("d"), "computed_at": F.timestamp_seconds("at"), "value": F.col("value").cast(M.VALUE)}).drop("d", "at")
    assert [int(r.value) for r in M.cumulative_from_metric(stored, "tx_count", "day").orderBy("period").collect()] == [10, 15]


def test_spans_of_two_platform_chains_stay_apart(spark):
    from blockloom.operators.joins import lookup_first, sum_in_span

    at = lambda s: F.timestamp_seconds(s)
    spans = spark.createDataFrame([(1, "v", "t", 0, 9), (2, "v", "t", 0, 9)], "p bigint, v string, tx string, a bigint, b bigint")
    spans = spans.withColumns({"start_time": at("a"), "end_time": at("b"), "start_exclusive": F.lit(False)})
    events = spark.createDataFrame([(1, "v", 5, 7), (2, "v", 5, 11)], "p bigint, v string, s bigint, amount bigint").withColumn("block_time", at("s"))
    got = {r.p: int(r.total) for r in sum_in_span(spans, events, ["p", "v"], ["p", "tx"]).collect()}
    assert got == {1: 7, 2: 11}
    found = lookup_first(spans.select("p", "v"), [events.select("p", "v", F.col("amount").alias("x"))], ["p", "v"], "x")
    assert {r.p: r.x for r in found.collect()} == got
