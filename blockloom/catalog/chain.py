"""Block normalisation, value decoding, and the example queries over raw tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from blockloom.catalog import plain, query
from blockloom.constants import MESSAGE_RECEIVED, MESSAGE_SENT
from blockloom.functions import hexes as H
from blockloom.functions import periods as P
from blockloom.functions import text as X
from blockloom.functions import u256 as U
from blockloom.operators import normalize as N
from blockloom.operators.quality import receipt_mismatch
from blockloom.plans import dashboards as Q
from blockloom.sources.star_schema import Star, with_tables
from blockloom.sources.tables import table_stats, to_json_rows

CHAIN = 7

# what the nested records of each line item contain
LINES = """
WITH l AS (SELECT l_orderkey * 8 + l_linenumber AS key, l_partkey AS part, l_suppkey AS supp, l_orderkey AS ok, l_linenumber AS line,
       CAST(round(l_extendedprice * 100) AS BIGINT) AS cents, CAST(l_quantity AS BIGINT) AS qty, l_discount, l_tax, l_linestatus,
       l_shipdate + to_seconds((l_orderkey * 7919) % 86400) + CASE WHEN l_tax <> 0 THEN to_milliseconds(l_partkey % 1000) ELSE INTERVAL 0 SECOND END AS t
  FROM lineitem)
"""
# 64-bit word that ends a 32-byte value
TIME = "strftime(t, '%Y-%m-%d %H:%M:%S')"


@query("normalize_blocks", "N1 N7 X1 X2 X3 S1", LINES + f"""
SELECT 7 AS chain_id, key AS block_number, key AS hash, greatest(key - 1, 0) AS parent_hash, {TIME} AS block_time, CAST(floor(epoch_ms(t)) AS BIGINT) % 1000 AS ms, supp AS miner,
       1 AS difficulty, CAST(key AS VARCHAR) AS total_difficulty, 1000 + part AS size, 8000000 AS gas_limit, qty * 100 + 21000 AS gas_used,
       CAST(CASE WHEN qty < 10 THEN 0 ELSE cents END AS VARCHAR) AS base_fee_per_gas, '0' AS block_gas_cost, part AS state_root, 1 AS sha3_uncles, part AS uncle,
       32 AS zero_hash_length, 0 AS extra_length, 8 AS nonce_length, '7' AS min_delay_excess
FROM l""")  # fmt: skip
def normalize_blocks(star: Star):
    b = N.normalize_blocks(star.nested_blocks(), CHAIN)
    return plain(
        b.select(
            "chain_id", "block_number", "hash", "parent_hash", "block_time", F.pmod(F.unix_millis("block_time"), F.lit(1000)).alias("ms"), "miner", "difficulty",
            "total_difficulty", "size", "gas_limit", "gas_used", "base_fee_per_gas", "block_gas_cost", "state_root", "sha3_uncles",
            F.col("uncles")[0].alias("uncle"), F.length("ext_data_hash").alias("zero_hash_length"), F.length("extra_data").alias("extra_length"),
            F.length("nonce").alias("nonce_length"), "min_delay_excess",
        )
    )


@query("normalize_txs", "N2 N3 N8 X4 J13", LINES + f"""
SELECT 7 AS chain_id, key * 2 + i AS hash, key AS block_number, {TIME} AS block_time, i AS transaction_index, CAST(line + i AS VARCHAR) AS nonce, part + i AS "from",
       CASE WHEN l_discount <> 0 THEN supp END AS "to", cents * (i + 1) AS value, 30000 AS gas_limit, CAST(cents + 25 AS VARCHAR) AS gas_price, qty * 100 + 21000 AS gas_used,
       l_linestatus = 'O' AS success, 2748 AS input, CASE WHEN i = 1 THEN 2 ELSE 0 END AS type,
       CASE WHEN l_tax <> 0 THEN CAST(cents * 2 AS VARCHAR) END AS max_fee_per_gas, CASE WHEN l_tax <> 0 THEN CAST(20 + i AS VARCHAR) END AS max_priority_fee_per_gas,
       CASE WHEN l_tax <> 0 THEN CASE WHEN qty < 10 OR cents = 0 THEN '0' ELSE CAST(20 + i AS VARCHAR) END END AS priority_fee_per_gas,
       CAST(CASE WHEN qty < 10 THEN 0 ELSE cents END AS VARCHAR) AS base_fee_per_gas, i AS listed, CASE WHEN i = 1 THEN supp END AS listed_address, CASE WHEN i = 1 THEN part END AS listed_key
FROM l, (VALUES (0), (1)) v(i)""")  # fmt: skip
def normalize_txs(star: Star):
    t = N.normalize_txs(N.tx_rows(star.nested_blocks(), CHAIN, parts=N.TX_PARTS))
    return plain(
        t.select(
            "chain_id", "hash", "block_number", "block_time", "transaction_index", "nonce", "from", "to", "value", "gas_limit", "gas_price", "gas_used", "success",
            "input", "type", "max_fee_per_gas", "max_priority_fee_per_gas", "priority_fee_per_gas", "base_fee_per_gas", F.size("access_list").alias("listed"),
            F.get("access_list", F.lit(0))["address"].alias("listed_address"), F.get(F.get("access_list", F.lit(0))["storage_keys"], F.lit(0)).alias("listed_key"),
        )
    )


@query("normalize_traces", "N4 N5 U1", LINES + f"""
SELECT 7 AS chain_id, key * 2 AS tx_hash, key AS block_number, {TIME} AS block_time, 0 AS transaction_index, path AS trace_address,
       CASE path WHEN '' THEN part WHEN '0.0' THEN supp + 1 ELSE supp END AS "from", CASE path WHEN '' THEN supp WHEN '0' THEN 0 WHEN '0.0' THEN part ELSE part END AS "to",
       CASE path WHEN '' THEN 16 WHEN '0' THEN 5 WHEN '0.0' THEN 4 ELSE 3 END AS gas, CASE path WHEN '' THEN 8 WHEN '0' THEN 0 WHEN '0.0' THEN 2 ELSE 1 END AS gas_used,
       CASE path WHEN '' THEN 1 ELSE 0 END AS value, CASE path WHEN '' THEN 'CALL' WHEN '0' THEN 'CREATE' WHEN '0.0' THEN 'STATICCALL' ELSE 'CALL' END AS call_type,
       l_linestatus = 'O' AS tx_success, part AS tx_from, CASE WHEN l_discount <> 0 THEN supp END AS tx_to
FROM l, (VALUES (''), ('0'), ('0.0'), ('1')) v(path)""")  # fmt: skip
def normalize_traces(star: Star):
    t = N.normalize_traces(N.tx_rows(star.nested_blocks(), CHAIN, parts=N.TRACE_PARTS), each_tx=plain)
    path = F.array_join(F.transform("trace_address", lambda x: x.cast("string")), ".")
    return plain(t.withColumn("trace_address", path).drop("input", "output"))


@query("normalize_logs", "N6 S3", LINES + f"""
SELECT 7 AS chain_id, supp + i AS address, key AS block_number, key AS block_hash, {TIME} AS block_time, key * 2 + i AS transaction_hash, i AS transaction_index, i AS log_index,
       part + i AS tx_from, CASE WHEN l_discount <> 0 THEN supp END AS tx_to, 'ddf252ad' AS topic0, part AS topic1, ok AS topic2, NULL::BIGINT AS topic3, cents AS data, FALSE AS removed
FROM l, (VALUES (0), (1)) v(i)""")  # fmt: skip
def normalize_logs(star: Star):
    logs = N.normalize_logs(N.tx_rows(star.nested_blocks(), CHAIN))
    return plain(logs.withColumn("topic0", F.substring(H.to_hex("topic0"), 1, 8)))


@query("assemble_blocks", "S3 J13", LINES + """
, u AS (SELECT key, l_linestatus, key * 1000 + row_number() OVER (PARTITION BY key ORDER BY l_linestatus) AS number FROM l)
SELECT 7 AS chain_id, key AS block_number, i AS pos, number * 2 + i AS tx_hash, number * 2 + i AS receipt_hash, CASE WHEN i = 0 THEN TRUE ELSE FALSE END AS traced, l_linestatus = 'O' AS success
FROM u, (VALUES (0), (1)) v(i)""")  # fmt: skip
def assemble_blocks(star: Star):
    # a chain never repeats a transaction hash
    nested = star.nested_blocks(unique=True)
    receipts = nested.select(F.explode("receipts").alias("receipt"))
    traces = nested.select(F.explode("traces").alias("trace")).where("trace.result is not null")
    rows = N.assemble_blocks(nested.select("block"), receipts, traces, CHAIN)
    return plain(
        rows.select(
            "chain_id", H.hex_to_uint("block.number", 32).alias("block_number"), "pos", H.hex_to_fixed("tx.hash", 32).alias("tx_hash"),
            H.hex_to_fixed("receipt.transactionHash", 32).alias("receipt_hash"), F.col("trace.txHash").isNotNull().alias("traced"), (F.col("receipt.status") == "0x1").alias("success"),
        )
    )


@query("receipt_mismatches", "D4", LINES + "SELECT key AS number, 2 AS txs, 1 AS receipts FROM l WHERE l_linestatus = 'F'")
def receipt_mismatches(star: Star):
    short = star.nested_blocks().withColumn(
        "receipts", F.when(F.col("receipts")[0]["status"] == "0x0", F.slice("receipts", 1, 1)).otherwise(F.col("receipts"))
    )
    return plain(receipt_mismatch(short).select(H.hex_to_uint("block_number", 32).alias("number"), "txs", "receipts"))


# --- values ---------------------------------------------------------------------------------


@query("decode_hex", "X1 X2 X3 X4 X6 X9", """
SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS q64, l_suppkey AS q32, CASE WHEN l_partkey < 256 THEN l_partkey END AS q8, (length(to_hex(l_partkey)) + 1) // 2 AS byte_count,
       l_partkey AS fixed, CAST(l_partkey AS VARCHAR) AS wide FROM lineitem""")  # fmt: skip
def decode_hex(star: Star):
    quantity = lambda c: F.concat(F.lit("0x"), F.lower(F.hex(c)))
    part = quantity("l_partkey")
    return plain(
        star.table("lineitem").select(
            "l_orderkey", "l_linenumber", H.hex_to_uint(part).alias("q64"), H.hex_to_uint(quantity("l_suppkey"), 32).alias("q32"), H.hex_to_uint(part, 8).alias("q8"),
            F.length(H.hex_to_bytes(part)).alias("byte_count"), H.hex_to_fixed(part, 20).alias("fixed"), U.u256_to_text(H.hex_to_u256(part)).alias("wide"),
        )
    )


@query("wide_arithmetic", "X5 X9", """
WITH v AS (SELECT l_orderkey, l_linenumber, l_suppkey, CAST(round(l_extendedprice * 100) AS HUGEINT) * 18446744073709551616::HUGEINT + l_partkey AS a, CAST(l_suppkey AS HUGEINT) * 18446744073709551616::HUGEINT * 10000 + 5 AS b FROM lineitem)
SELECT l_orderkey, l_linenumber, CAST(a - b AS VARCHAR) AS diff, CAST(a // 1000000 AS VARCHAR) AS millionth, CAST(a // 1000000000000000000 AS VARCHAR) AS coins,
       CASE WHEN a < b THEN -1 WHEN a > b THEN 1 ELSE 0 END AS cmp, '0x' || lpad(lower(to_hex(a)), 64, '0') AS hex FROM v""")  # fmt: skip
def wide_arithmetic(star: Star):
    a = U.u256_from_words(F.round(F.col("l_extendedprice") * 100).cast("bigint"), F.col("l_partkey"))
    b = U.u256_from_words(F.col("l_suppkey") * 10000, F.when(F.col("l_suppkey") >= 0, 5))
    rows = star.spread("lineitem").select("l_orderkey", "l_linenumber", a.alias("a"), b.alias("b"))
    values = rows.withColumns({"d": U.u256_diff("a", "b"), "m": U.u256_div("a", 10**6), "c": U.u256_div("a", 10**18)})
    return plain(
        values.select(
            "l_orderkey", "l_linenumber", U.signed_text("d").alias("diff"), U.u256_to_text("m").alias("millionth"), U.u256_to_text("c").alias("coins"),
            U.u256_cmp("a", "b").alias("cmp"), U.u256_to_hex("a").alias("hex"),
        )
    )


@query("priority_fees", "N8", """
WITH v AS (SELECT l_orderkey, l_linenumber, CAST(round(l_extendedprice) AS BIGINT) AS p, l_partkey * 20 AS b, l_suppkey * 100 AS m FROM lineitem)
SELECT l_orderkey, l_linenumber, CAST(CASE WHEN b = 0 THEN 0 WHEN m > 0 AND greatest(p - b, 0) > m THEN m ELSE greatest(p - b, 0) END AS VARCHAR) AS tip FROM v""")  # fmt: skip
def priority_fees(star: Star):
    tip = N.priority_fee(F.round("l_extendedprice").cast("bigint"), F.col("l_partkey") * 20, F.col("l_suppkey") * 100)
    return plain(star.table("lineitem").select("l_orderkey", "l_linenumber", tip.alias("tip")))


@query("block_times", "N7", """
SELECT event_id, strftime(CASE WHEN event_id % 2 = 0 THEN date_trunc('millisecond', ts) ELSE date_trunc('second', ts) END, '%Y-%m-%d %H:%M:%S.%g') AS t FROM events""")  # fmt: skip
def block_times(star: Star):
    ts = F.col("ts").cast("timestamp")
    t = P.block_time(F.when(F.pmod("event_id", F.lit(2)) == 0, F.unix_millis(ts)).otherwise(0), F.unix_timestamp(ts))
    return star.table("events").select("event_id", F.date_format(t, "yyyy-MM-dd HH:mm:ss.SSS").alias("t"))


@query("text_functions", "X13 X14 X16 X18 N10", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS iso, date_diff('day', o_orderdate, TIMESTAMP '2001-01-01 00:00:00') AS days,
       CAST(CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey ELSE 0 END AS VARCHAR) AS number, CAST(CAST(floor(o_totalprice) AS BIGINT) // 7 AS VARCHAR) AS seventh, nullif(o_orderstatus, 'P') AS status,
       substr('AddValidatorTx', 1, 12) AS kind FROM orders""")  # fmt: skip
def text_functions(star: Star):
    t = F.col("o_orderdate").cast("timestamp")
    key = F.col("o_orderkey").cast("string")
    return plain(
        star.table("orders").select(
            "o_orderkey", X.fmt_time(t, X.DATE_PATTERN).alias("day"), X.fmt_time(t, X.ISO_PATTERN).alias("iso"), X.days_between(t, F.lit("2001-01-01").cast("timestamp")).alias("days"),
            X.to_uint_or_zero(F.when(F.pmod("o_orderkey", F.lit(2)) == 0, key).otherwise(F.concat(F.lit("x"), key))).alias("number"),
            X.trunc_div(F.floor("o_totalprice"), F.lit(7)).alias("seventh"), X.null_if("o_orderstatus", "P").alias("status"), X.tx_type_name(F.lit("AddValidatorTx")).alias("kind"),
        )
    )


# exact ties round up, which printf alone does not do
_FIXED = "printf('%.{p}f', {x} + CASE WHEN {x} * {h} = floor({x} * {h}) AND floor({x} * {h}) % 2 = 1 THEN 1e-7 ELSE 0 END)"


def _fixed(x: str, places: int) -> str:
    return _FIXED.format(x=f"({x})", p=places, h=2 ** (places + 1))


@query("readable_numbers", "X19", f"""
WITH v AS (SELECT o_orderkey, CAST(CAST(floor(o_totalprice) AS BIGINT) * (o_orderkey % 4 * 100 + 1) * 3 AS DOUBLE) AS n FROM orders)
SELECT o_orderkey, CASE WHEN n >= 1e9 THEN {_fixed('n / 1e9', 2)} || 'B' WHEN n >= 1e6 THEN {_fixed('n / 1e6', 2)} || 'M' WHEN n >= 1e3 THEN {_fixed('n / 1e3', 2)} || 'K' ELSE {_fixed('n', 0)} END AS short,
       {_fixed('n / 1073741824', 3)} || ' GB' AS gb FROM v""")  # fmt: skip
def readable_numbers(star: Star):
    n = F.floor("o_totalprice").cast("bigint") * (F.pmod("o_orderkey", F.lit(4)) * 100 + 1) * 3
    return star.table("orders").select("o_orderkey", X.readable(n).alias("short"), X.gigabytes(n).alias("gb"))


@query("amounts_and_ages", "X19 X21", f"""
WITH v AS (SELECT event_id, ts, CAST(event_id * 1000000007 AS DOUBLE) / 1e9 AS c, CAST(epoch(TIMESTAMP '2024-01-31 00:00:00') AS BIGINT) - CAST(floor(epoch(ts)) AS BIGINT) AS age FROM events)
SELECT event_id, CASE WHEN c >= 1e6 THEN {_fixed('c / 1e6', 2)} || 'M' WHEN c >= 1e3 THEN {_fixed('c / 1e3', 2)} || 'K' WHEN c >= 1 THEN {_fixed('c', 2)} ELSE {_fixed('c', 4)} END AS coins,
       CASE WHEN age < 60 THEN age || 's ago' WHEN age < 3600 THEN age // 60 || 'm ago' WHEN age < 86400 THEN age // 3600 || 'h ago' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS age FROM v""")  # fmt: skip
def amounts_and_ages(star: Star):
    ts = F.col("ts").cast("timestamp")
    return star.table("events").select("event_id", X.nano_amount(F.col("event_id") * 1000000007).alias("coins"), X.age_text(ts, F.lit("2024-01-31").cast("timestamp")).alias("age"))


@query("field_names", "X22", """
SELECT event_type, 'Total ' || upper(substr(event_type, 1, 1)) || substr(event_type, 2) AS title, count(*) AS n FROM events GROUP BY 1, 2""")  # fmt: skip
def field_names(star: Star):
    title = X.humanize_field(F.concat(F.lit("total"), F.initcap("event_type")))
    return star.table("events").groupBy("event_type", title.alias("title")).agg(F.count("*").alias("n"))


# --- example queries --------------------------------------------------------------------------

_T = "strftime({}, '%Y-%m-%d %H:%M:%S')".format
_SINCE = "1996-06-01"


@query("txs_per_hour", "Q-19", with_tables("raw_txs") + f"""
SELECT chain_id, {_T("date_trunc('hour', block_time)")} AS hour, count(*) AS tx_count FROM raw_txs WHERE block_time >= TIMESTAMP '{_SINCE}' GROUP BY 1, 2""")  # fmt: skip
def txs_per_hour(star: Star):
    return plain(Q.txs_per_hour(star.raw_txs(), None, _SINCE))


@query("logs_by_signature", "Q-20", with_tables("message_logs") + f"""
SELECT block_number, {_T("block_time")} AS block_time, address AS contract_address, transaction_hash, log_index FROM message_logs WHERE topic0 = 'sent'""")  # fmt: skip
def logs_by_signature(star: Star):
    return plain(Q.logs_by_signature(star.message_logs(), None, MESSAGE_SENT))


@query("logs_per_day", "Q-21", with_tables("message_logs") + f"""
SELECT chain_id, {_T("date_trunc('day', block_time)")} AS day, count(*) AS receive_count FROM message_logs WHERE topic0 = 'received' GROUP BY 1, 2""")  # fmt: skip
def logs_per_day(star: Star):
    return plain(Q.logs_per_day(star.message_logs(), None, MESSAGE_RECEIVED))


@query("gas_per_day", "Q-22", with_tables("raw_txs") + f"""
SELECT chain_id, {_T("date_trunc('day', block_time)")} AS day, CAST(sum(gas_used) AS BIGINT) AS total_gas_used FROM raw_txs GROUP BY 1, 2""")  # fmt: skip
def gas_per_day(star: Star):
    return plain(Q.gas_per_day(star.raw_txs()))


@query("deployments", "Q-23", with_tables("raw_txs") + f"""
SELECT block_number, {_T("block_time")} AS block_time, hash AS tx_hash, sender AS deployer, contract_address FROM raw_txs WHERE recipient IS NULL AND success""")  # fmt: skip
def deployments(star: Star):
    return plain(Q.deployments(star.raw_txs()))


@query("senders_per_day", "Q-24", with_tables("raw_txs") + f"""
SELECT chain_id, {_T("date_trunc('day', block_time)")} AS day, count(DISTINCT sender) AS unique_senders FROM raw_txs GROUP BY 1, 2""")  # fmt: skip
def senders_per_day(star: Star):
    return plain(Q.senders_per_day(star.raw_txs()))


@query("gas_price_per_hour", "Q-25", with_tables("raw_txs") + f"""
SELECT chain_id, {_T("date_trunc('hour', block_time)")} AS hour, avg(gas_price) AS avg_gas_price, max(gas_price) AS max_gas_price FROM raw_txs GROUP BY 1, 2""")  # fmt: skip
def gas_price_per_hour(star: Star):
    return plain(Q.gas_price_per_hour(star.raw_txs()))


@query("contract_events", "Q-26", with_tables("token_logs") + f"""
SELECT block_number, {_T("block_time")} AS block_time, block_number * 8 + chain_id AS transaction_hash, chain_id AS log_index, w1 AS topic1, w2 AS topic2, whole FROM token_logs WHERE token = 5""")  # fmt: skip
def contract_events(star: Star):
    rows = Q.contract_events(star.token_logs(), None, f"{5:040x}")
    return plain(rows.withColumn("whole", F.length("data") == 32).drop("topic0", "data"))


@query("creates_per_day", "Q-28 A12", with_tables("raw_traces") + f"""
SELECT chain_id, {_T("date_trunc('day', block_time)")} AS day, call_type, count(*) AS create_count FROM raw_traces WHERE call_type IN ('CREATE', 'CREATE2', 'CREATE3') GROUP BY 1, 2, 3""")  # fmt: skip
def creates_per_day(star: Star):
    return plain(Q.creates_per_day(star.raw_traces()))


@query("messages_per_week", "Q-29", with_tables("message_logs") + f"""
SELECT chain_id, {_T("date_trunc('week', block_time + INTERVAL 1 DAY) - INTERVAL 1 DAY")} AS week, count(*) AS total_icm_messages FROM message_logs WHERE topic0 IN ('sent', 'received') GROUP BY 1, 2""")  # fmt: skip
def messages_per_week(star: Star):
    return plain(Q.messages_per_week(star.message_logs()))


@query("adhoc_sql", "Q-30 V10", with_tables("raw_txs") + f"""
SELECT chain_id, {_T("date_trunc('month', block_time)")} AS period, CAST(sum(gas_used) AS BIGINT) AS value FROM raw_txs WHERE block_time >= TIMESTAMP '{_SINCE}' AND success GROUP BY 1, 2""")  # fmt: skip
def adhoc_sql(star: Star):
    star.raw_txs().createOrReplaceTempView("blockloom_adhoc_txs")
    return plain(
        Q.run_sql(
            star.spark,
            "SELECT chain_id, date_trunc('{granularity}', block_time) AS period, sum(gas_used) AS value FROM blockloom_adhoc_txs"
            " WHERE block_time >= cast(:first AS timestamp) AND success GROUP BY 1, 2",
            {"first": _SINCE},
            {"granularity": "month"},
        )
    )


@query("latest_blocks", "Q-31 K3", with_tables("raw_blocks") + f"""
SELECT chain_id, block_number, {_T("block_time")} AS block_time, lpad(lower(to_hex(block_number)), 64, '0') AS hash, lpad(lower(to_hex(greatest(block_number - 1, 0))), 64, '0') AS parent_hash, gas_used
FROM raw_blocks ORDER BY block_number DESC, chain_id LIMIT 5""")  # fmt: skip
def latest_blocks(star: Star):
    return plain(Q.latest_blocks(star.raw_blocks()))


@query("tx_sample", "Q-31 X6", with_tables("raw_txs") + """
SELECT block_number, transaction_index, lpad(lower(to_hex(hash)), 64, '0') AS hash, lpad(lower(to_hex(sender)), 40, '0') AS "from", lpad(lower(to_hex(recipient)), 40, '0') AS "to", CAST(value AS VARCHAR) AS value, gas_used
FROM raw_txs ORDER BY block_number DESC, transaction_index, raw_txs.hash, sender, recipient NULLS FIRST, raw_txs.value LIMIT 10""")  # fmt: skip
def tx_sample(star: Star):
    return plain(Q.tx_sample(star.raw_txs()))


@query("sync_status", "Q-1 J3 V7", """
WITH c AS (SELECT CAST(n_nationkey AS BIGINT) AS k, n_name FROM nation),
     w AS (SELECT k, k * 1000 + 500 - k * k * 3 AS b FROM c WHERE k % 3 <> 2)
SELECT c.k AS chain_id, n_name AS name, 1700000000 - c.k * c.k * 30 AS last_updated, c.k * 1000 + 500 AS last_block_on_chain, b AS watermark_block,
       coalesce(b / (c.k * 1000 + 500) * 100, 0.0) AS sync_percentage, c.k * 1000 + 500 - b AS blocks_behind FROM c LEFT JOIN w ON c.k = w.k""")  # fmt: skip
def sync_status(star: Star):
    return plain(Q.sync_status(star.chain_status(), star.sync_watermarks()))


@query("sync_health", "Q-2", """
WITH c AS (SELECT CAST(n_nationkey AS BIGINT) AS k FROM nation), s AS (SELECT k, CASE WHEN k % 3 <> 2 THEN k * k * 3 END AS behind, k * k * 30 + 5 AS age FROM c)
SELECT k AS chain_id, CASE WHEN behind IS NULL THEN 'gray' WHEN behind < 10 THEN 'green' WHEN behind < 1000 THEN 'yellow' ELSE 'red' END AS lag_health,
       CASE WHEN age < 60 THEN 'green' WHEN age < 3600 THEN 'yellow' ELSE 'red' END AS age_health FROM s""")  # fmt: skip
def sync_health(star: Star):
    status = Q.sync_status(star.chain_status(), star.sync_watermarks())
    return Q.health(status, F.timestamp_seconds(F.lit(1700000005))).select("chain_id", "lag_health", "age_health")


@query("json_rows", "S10", """
SELECT '{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '","n_regionkey":' || n_regionkey || '}' AS json FROM nation""")  # fmt: skip
def json_rows(star: Star):
    return to_json_rows(star.table("nation"))


@query("table_sizes", "S12 A10", """
SELECT 'orders' AS "table", count(*) AS rows FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'events', count(*) FROM events""")  # fmt: skip
def table_sizes(star: Star):
    stats = table_stats(star.spark, {n: f"{star.folder}/{n}.parquet" for n in ("orders", "lineitem", "events")})
    return stats.where("size_bytes > 0 and bytes_per_row > 0").select("table", "rows")
