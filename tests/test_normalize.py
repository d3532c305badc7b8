"""Hand-made blocks read from JSON files as a node delivers them."""

import json

import pytest
from pyspark.sql import functions as F

from blockloom.operators import normalize as N
from blockloom.operators.quality import receipt_mismatch
from blockloom.sources.blocks import read_blocks
from blockloom.streaming.ingest import raw_tables


def h(n, size=32):
    return "0x" + f"{n:0{2 * size}x}"


def tx(n, i, to=h(7, 20), **more):
    return {"hash": h(n * 10 + i), "nonce": "0x1", "transactionIndex": hex(i), "from": h(100 + i, 20), "to": to, "value": "0x" + "f" * 64, "gas": "0x5208", "gasPrice": "0x64", "input": "0x", **more}


def receipt(n, i, logs=(), **more):
    return {"gasUsed": "0x10", "logs": list(logs), "status": "0x1", "transactionHash": h(n * 10 + i), "contractAddress": None, **more}


def log(n, i, topics, data="0x01"):
    return {"address": h(55, 20), "topics": topics, "data": data, "transactionHash": h(n * 10 + i), "transactionIndex": hex(i), "logIndex": "0x0", "removed": False}


def block(n, txs, **more):
    zero = h(0)
    return {
        "number": hex(n), "hash": h(n), "parentHash": h(n - 1), "timestamp": hex(1700000000 + n), "miner": h(1, 20), "difficulty": "0x1", "totalDifficulty": hex(n), "size": "0x2", "gasLimit": "0x3", "gasUsed": "0x4",
        "transactions": txs, "stateRoot": zero, "transactionsRoot": zero, "receiptsRoot": zero, "mixHash": zero, "nonce": "0x0", "sha3Uncles": zero, "uncles": [h(9)], **more,
    }


DEEP = {"type": "CALL", "from": h(1, 20), "to": h(2, 20)}
for _ in range(1000):
    DEEP = {"type": "call", "from": h(1, 20), "to": h(2, 20), "calls": [DEEP]}

RECORDS = [
    {
        "block": block(1, [tx(1, 0, to=None), tx(1, 1)], timestampMilliseconds=hex(1700000001234), baseFeePerGas="0x50"),
        "receipts": [receipt(1, 0, [log(1, 0, [])], contractAddress=h(77, 20)), receipt(1, 1, [log(1, 1, [h(3), h(4)], "0xzz")], status="0x0")],
        "traces": [
            {"txHash": h(10), "result": {"type": "create", "from": h(1, 20), "gas": "0x5", "gasUsed": "oops", "value": "0x2", "calls": [
                {"type": "call", "from": h(2, 20), "to": h(3, 20), "calls": [{"type": "", "from": h(3, 20), "to": h(4, 20)}]}, {"type": "delegatecall", "from": h(5, 20), "to": "0x"}]}},
            {"txHash": h(11), "result": None},
        ],
    },
    {
        "block": block(2, [tx(2, 0, type="0x2", maxFeePerGas="0x70", maxPriorityFeePerGas="0x5", accessList=[{"address": h(8, 20), "storageKeys": [h(6), "0x" + "1" * 80]}, {"address": "0x" + "2" * 60, "storageKeys": []}])], baseFeePerGas="0x50"),
        "receipts": [receipt(2, 0)],
        "traces": [{"txHash": h(20), "result": DEEP}],
    },
    {"block": block(3, []), "receipts": [], "traces": []},
]


@pytest.fixture(scope="module")
def nested(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("blocks") / "a.json"
    path.write_text("\n".join(json.dumps(r) for r in RECORDS))
    return read_blocks(spark, str(path.parent)).persist()


def hx(c):
    return F.lower(F.hex(c))


def test_blocks(nested):
    rows = {r.block_number: r for r in N.normalize_blocks(nested, 5).withColumn("ms", F.unix_millis("block_time")).collect()}
    assert {n: r.ms for n, r in rows.items()} == {1: 1700000001234, 2: 1700000002000, 3: 1700000003000}
    assert bytes(rows[1].uncles[0]).hex() == h(9)[2:] and bytes(rows[1].ext_data_hash) == bytes(32) and rows[3].base_fee_per_gas == 0 and rows[1].chain_id == 5


def test_block_range(spark, nested, tmp_path):
    path = tmp_path / "block_group=0"
    path.mkdir()
    (path / "a.json").write_text("\n".join(json.dumps(r) for r in RECORDS))
    assert read_blocks(spark, str(tmp_path), 2, 2).count() == 1 and read_blocks(spark, str(tmp_path), 2).count() == 2


def test_transactions(nested):
    rows = {bytes(r.hash).hex()[-2:]: r for r in N.normalize_txs(N.tx_rows(nested, 5)).collect()}
    creation, failed, typed = rows["0a"], rows["0b"], rows["14"]
    assert creation.to is None and bytes(creation.contract_address).hex() == h(77, 20)[2:] and creation.success and not failed.success
    assert bytes(creation.value).hex() == "f" * 64 and creation.type == 0 and creation.max_fee_per_gas is None and creation.priority_fee_per_gas is None
    assert (typed.type, typed.max_fee_per_gas, typed.priority_fee_per_gas) == (2, 0x70, 5)
    assert len(typed.access_list) == 1 and [k is None for k in typed.access_list[0].storage_keys] == [False, True]


def test_call_trees(nested):
    rows = N.normalize_traces(N.tx_rows(nested, 5)).collect()
    first = sorted((r for r in rows if r.block_number == 1), key=lambda r: r.trace_address)
    assert [(r.trace_address, r.call_type) for r in first] == [([], "CREATE"), ([0], "CALL"), ([0, 0], "CALL"), ([1], "DELEGATECALL")]
    assert first[0].gas_used == 0 and bytes(first[0].to) == bytes(20) and bytes(first[3].to) == bytes(20) and first[0].tx_to is None
    deep = [r for r in rows if r.block_number == 2]
    assert len(deep) == 1001 and max(len(r.trace_address) for r in deep) == 1000
    assert {r.transaction_index for r in rows} == {0}


def test_logs(nested):
    rows = sorted(N.normalize_logs(N.tx_rows(nested, 5)).collect(), key=lambda r: r.transaction_index)
    assert bytes(rows[0].topic0) == bytes(32) and rows[0].topic1 is None and bytes(rows[0].data) == b"\x01"
    assert bytes(rows[1].topic1).hex() == h(4)[2:] and rows[1].topic2 is None and bytes(rows[1].data) == b""


def test_missing_receipts(spark, nested):
    short = nested.withColumn("receipts", F.slice("receipts", 1, 1))
    assert [(r.txs, r.receipts) for r in receipt_mismatch(short).collect()] == [(2, 1)]
    assert N.tx_rows(short, 5, strict=False).count() == 1
    with pytest.raises(Exception, match="receipt count differs"):
        N.tx_rows(short, 5).count()
    receipts = nested.select(F.explode("receipts").alias("receipt"))
    traces = nested.select(F.explode("traces").alias("trace"))
    assert N.assemble_blocks(nested.select("block"), receipts, traces, 5).count() == 3
    with pytest.raises(Exception, match="no receipt"):
        N.assemble_blocks(nested.select("block"), receipts.where(F.col("receipt.status") == "0x1"), traces, 5).collect()


def test_stored_schemas(spark, nested):
    from blockloom import schemas

    for name, df in raw_tables(nested, 5).items():
        want = spark.createDataFrame([], schemas.RAW_TABLES[name]).schema
        assert [(f.name, f.dataType.simpleString()) for f in df.schema] == [(f.name, f.dataType.simpleString()) for f in want], name


def test_priority_fee(spark):
    cases = [(100, 0, 5, 0), (100, 80, 5, 5), (100, 98, 5, 2), (100, 80, 0, 20), (50, 80, 5, 0)]
    df = spark.createDataFrame(cases, "p bigint, b bigint, m bigint, want bigint")
    assert all(r.got == r.want for r in df.withColumn("got", N.priority_fee("p", "b", "m")).collect())
