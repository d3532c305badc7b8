"""Steps whose cost per row has to stay small: same values as plain Python, and plans without the costly form."""

from datetime import datetime

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from blockloom.catalog import exact, load
from blockloom.functions.hexes import hex_to_fixed, hex_to_uint, text_of, wide_of
from blockloom.functions.u256 import u256_div, u256_from_words, u256_to_text
from blockloom.operators import normalize as N
from blockloom.operators.normalize import assemble_blocks
from blockloom.operators.quality import receipt_mismatch
from blockloom.sources.star_schema import Star


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_receipt_mismatch_is_no_filter(spark):
    # a filter on the sizes would be pushed below the repartition, to the few tasks of a scan
    blocks = spark.range(4).repartition(2).select(
        F.struct(F.col("id").cast("string").alias("number"), F.array(F.col("id").cast("string"), F.lit("t")).alias("transactions")).alias("block"),
        F.when(F.col("id") % 2 == 0, F.array(F.lit("r"), F.lit("s"))).when(F.col("id") == 1, F.array(F.lit("r"))).alias("receipts"),
    )
    found = receipt_mismatch(blocks)
    assert "Filter" not in optimized(found)
    assert sorted(map(tuple, found.collect()))[0] == ("1", 2, 1)
    assert found.columns == ["block_number", "txs", "receipts"]


def test_quotient_is_plain_arithmetic(spark):
    values = [0, 1, 2**24, 2**64 + 5, 10**18, 7 * 10**30 + 123456789, 2**255 + 3, 2**256 - 1]
    rows = spark.createDataFrame([(bytearray(v.to_bytes(32, "big")),) for v in values], "v binary")
    for divisor in (1, 7, 10**6, 10**18, 10**24):
        out = rows.select("v", u256_div("v", divisor).alias("q"))
        assert "lambda" not in optimized(out)  # a higher-order function runs without generated code
        got = {int.from_bytes(r.v, "big"): int.from_bytes(r.q, "big") for r in out.collect()}
        assert got == {v: v // divisor for v in values}


def test_padding(spark):
    rows = spark.createDataFrame([("0x1",), ("0x",), ("ab" * 20,), ("ab" * 21,), ("0xzz",), (None,)], "h string")
    got = {r.h: r.f for r in rows.select("h", hex_to_fixed("h", 20).alias("f")).collect()}
    assert got["0x1"] == bytes(19) + b"\x01" and got["0x"] == bytes(20) == got[None]
    assert got["ab" * 20] == b"\xab" * 20 and got["ab" * 21] is None and got["0xzz"] is None
    numbers = spark.createDataFrame([(0,), (255,), (2**63 - 1,), (None,)], "n bigint")
    for r in numbers.select("n", wide_of("n", 20).alias("w"), u256_to_text(u256_from_words("n", F.lit(3))).alias("t")).collect():
        assert r.w == (None if r.n is None else f"{r.n:040X}")
        if r.n is not None:
            assert r.t == str(r.n * 2**64 + 3)


def test_stages_of_long_methods_are_split(spark):
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def _star(spark, tmp_path, rows: dict[str, tuple[list, str]]):
    for name, (values, schema) in rows.items():
        spark.createDataFrame(values, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return Star(spark, str(tmp_path))


def test_sketches_do_not_travel_with_distinct_values(spark, tmp_path):
    lines = [(n, p, s) for n in (None, 1, 2) for p in (1, 2, 3) for s in (5, 6)]
    star = _star(spark, tmp_path, {"lineitem": (lines * 2, "l_linenumber int, l_partkey bigint, l_suppkey bigint")})
    found = load()["agg_distinct_estimate_bounds"].run(star)
    assert "Expand" not in optimized(found)
    assert sorted(map(str, found.collect())) == sorted(f"Row(l_linenumber={n}, parts=True, pairs=True)" for n in (None, 1, 2))


def test_whole_receipts_do_not_travel(spark):
    blocks = spark.range(3).select(F.expr("named_struct('number', '0x1', 'hash', '0x1', 'timestamp', '0x1', 'timestampMilliseconds', '0x1', 'baseFeePerGas', '0x0', 'transactions', array(named_struct('hash', string(id)))) AS block"))
    receipts = spark.createDataFrame([(str(i), "0x1", "many logs") for i in range(3)], "h string, s string, l string").repartition(2)
    receipts = receipts.select(F.expr("named_struct('transactionHash', h, 'status', s, 'logs', l) AS receipt"))
    traces = spark.createDataFrame([("1", "calls")], "h string, r string").select(F.expr("named_struct('txHash', h, 'result', r) AS trace"))
    rows = assemble_blocks(blocks, receipts, traces, 1)
    some = rows.select(F.col("tx.hash").alias("h"), F.col("receipt.status").alias("s"), F.col("trace.txHash").alias("t"))
    assert "logs" not in optimized(some) and "result" not in optimized(some)
    assert sorted(map(tuple, some.collect())) == [("0", "0x1", None), ("1", "0x1", "1"), ("2", "0x1", None)]
    assert set(rows.columns) == {"chain_id", "block", "pos", "tx", "receipt", "trace"}


def test_building_spreads_over_the_cores(spark, tmp_path):
    """One file of one row group is a single task, whatever its size."""
    customers = [(i, 1.0, "BUILDING") for i in range(50)]
    events = [(i, datetime(2024, 1, 1), 1, "click", 1.0) for i in range(50)]
    star = _star(spark, tmp_path, {"customer": (customers, "c_custkey bigint, c_acctbal double, c_mktsegment string"), "events": (events, "event_id bigint, ts timestamp, user_id bigint, event_type string, value double")})
    cores = spark.sparkContext.defaultParallelism
    for df in (star.snapshot(), star.nested_events()):
        assert df.rdd.getNumPartitions() >= cores and df.count() == 50
    # neighbours stay together, so that a group of blocks is in few files
    numbers = star.nested_events().select(F.spark_partition_id().alias("p"), F.conv(F.substring("block.number", 3, 16), 16, 10).cast("int").alias("n"))
    ends = sorted((r.low, r.high) for r in numbers.groupBy("p").agg(F.min("n").alias("low"), F.max("n").alias("high")).collect())
    assert len(ends) > 1 and all(a[1] < b[0] for a, b in zip(ends, ends[1:]))


LINES = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_linestatus string, l_shipdate timestamp"


def _lines(spark, tmp_path):
    rows = [(1, 2, 3, 1, 5.0, 10.5, 0.0, 0.1, "O", datetime(1995, 1, 1)), (1, 2, 3, 1, 5.0, 10.5, 0.1, 0.0, "F", datetime(1995, 1, 1)), (2**20, 255, None, 2, 50.0, 99.25, 0.1, 0.0, "F", datetime(1996, 5, 5))]
    return _star(spark, tmp_path, {"lineitem": (rows, LINES)})


def test_digits_are_not_counted_as_characters(spark):
    odd = ["0x", "", None, "0x1", "0x00000000000000000000ff", "ff", "0xFF", "0xé", "é" * 4, "0x" + "f" * 16, "0x" + "f" * 17, "zz"]
    rows = spark.createDataFrame([(v,) for v in odd], "h string")
    found = rows.select("h", hex_to_fixed("h", 4).alias("f"), hex_to_uint("h").alias("n"), hex_to_uint("h", 8).alias("small"))
    got = {r.h: (r.f and bytes(r.f).hex(), r.n if r.n is None else int(r.n), r.small) for r in found.collect()}
    assert got == {
        "0x": ("00000000", 0, 0), "": ("00000000", 0, 0), None: ("00000000", 0, 0), "0x1": ("00000001", 1, 1), "0x00000000000000000000ff": (None, 255, 255), "ff": ("000000ff", 255, 255),
        "0xFF": ("000000ff", 255, 255), "0xé": (None, None, None), "éééé": (None, None, None), "0x" + "f" * 16: (None, 2**64 - 1, None), "0x" + "f" * 17: (None, None, None), "zz": (None, None, None),
    }
    fixed = optimized(rows.select(hex_to_fixed("h", 4)))
    assert "octet_length" in fixed and "as binary), 3" in fixed
    numbers = spark.createDataFrame([(0,), (255,), (-1,), (2**63 - 1,), (None,)], "n bigint")
    for r in numbers.select("n", text_of("n", 20).alias("t")).collect():
        assert r.t == (None if r.n is None else f"0x{r.n % 2**64:040x}")


def test_unread_fields_of_records_are_not_built(spark, tmp_path):
    blocks = _lines(spark, tmp_path).nested_blocks()
    assert "transactions" not in optimized(blocks.select("block.number", "block.hash"))
    whole = N.tx_rows(blocks, 7)
    for parts, read in ((N.TRACE_PARTS, N.normalize_traces), (N.TX_PARTS, N.normalize_txs)):
        some = N.tx_rows(blocks, 7, parts=parts)
        assert {n: tuple(some.schema[n].dataType.names) for n in parts} == parts
        assert sorted(map(repr, read(some).collect())) == sorted(map(repr, read(whole).collect()))
    assert "topics" in optimized(whole) and "topics" not in optimized(N.tx_rows(blocks, 7, parts=N.TRACE_PARTS))
    short = blocks.withColumn("receipts", F.slice("receipts", 1, 1))
    assert N.tx_rows(short, 7, strict=False, parts=N.TX_PARTS).count() == 0
    with pytest.raises(Exception, match="receipt count differs"):
        N.tx_rows(short, 7, parts=N.TX_PARTS).count()


def test_transactions_are_shown_once_not_for_each_call(spark, tmp_path):
    rows = N.tx_rows(_lines(spark, tmp_path).nested_blocks(), 7, parts=N.TRACE_PARTS)
    shown = exact(N.normalize_traces(rows, each_tx=exact))
    above = optimized(shown).split("Generate explode")[0]
    assert "date_format" not in above and "lower(hex(tx_hash" not in above
    assert sorted(map(repr, shown.collect())) == sorted(map(repr, exact(N.normalize_traces(rows)).collect()))


def test_calls_are_gathered_by_field():
    texts = [None, "", "{}", '{"from":"a","gas":NaN,"calls":[{"from":"b","calls":[{"to":"c"}]},{"type":"é"}]}', '{"calls":[]}']
    call = lambda path, **f: {"path": path, **{n: f.get(n) for n in N._CALL_FIELDS}}
    want = [call([], **{"from": "a"}), call([0], **{"from": "b"}), call([0, 0], to="c"), call([1], type="é")]
    assert N._walk(pa.array(texts, pa.string())).to_pylist() == [None, None, None, want, [call([])]]
    assert N._walk(pa.array([], pa.string())).to_pylist() == []
    for bad in ("{bad", "[1]", '{"from":5}', '{"calls":[null]}'):
        with pytest.raises(Exception):
            N._walk(pa.array([bad]))
