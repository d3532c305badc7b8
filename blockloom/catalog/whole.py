"""Normalised rows with every column and byte, and the display, status and chain-filter features on whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockloom.catalog import CATALOG, exact, period_sql, plain, platform, query, text_time
from blockloom.catalog.balances import ENTRIES
from blockloom.catalog.chain import CHAIN, LINES, _fixed
from blockloom.catalog.metrics import _tables
from blockloom.constants import TRANSFER
from blockloom.functions import text as X
from blockloom.functions.periods import GRANULARITIES
from blockloom.operators import aggregates as A
from blockloom.operators import normalize as N
from blockloom.plans import balances as B
from blockloom.plans import dashboards as Q
from blockloom.plans import metrics as M
from blockloom.session import scratch
from blockloom.sources import tables as ST
from blockloom.sources.platform import read_platform_txs
from blockloom.sources.star_schema import Star, with_tables

# --- normalised rows, whole -------------------------------------------------------------------

_MS = "strftime(t, '%Y-%m-%d %H:%M:%S.%g')"
_W32 = "lpad(lower(to_hex({})), 64, '0')".format
_W20 = "lpad(lower(to_hex({})), 40, '0')".format
_ZERO = "repeat('0', 64)"
_FEE = "CAST(CASE WHEN qty < 10 THEN 0 ELSE cents END AS VARCHAR)"


@query("raw_block_rows", "N1 N7 X1 X2 X3 S1", LINES + f"""
SELECT 7 AS chain_id, key AS block_number, {_W32("key")} AS hash, {_W32("greatest(key - 1, 0)")} AS parent_hash, {_MS} AS block_time, {_W20("supp")} AS miner, 1 AS difficulty,
       CAST(key AS VARCHAR) AS total_difficulty, 1000 + part AS size, 8000000 AS gas_limit, qty * 100 + 21000 AS gas_used, {_FEE} AS base_fee_per_gas, '0' AS block_gas_cost,
       {_W32("part")} AS state_root, {_W32("supp")} AS transactions_root, {_W32("part + 1")} AS receipts_root, '' AS extra_data, '' AS block_extra_data, {_ZERO} AS ext_data_hash,
       0 AS ext_data_gas_used, {_ZERO} AS mix_hash, '0000000000000000' AS nonce, {_W32("1")} AS sha3_uncles, {_W32("part")} AS uncles, 0 AS blob_gas_used, '0' AS excess_blob_gas,
       {_ZERO} AS parent_beacon_block_root, '7' AS min_delay_excess
FROM l""")  # fmt: skip
def raw_block_rows(star: Star):
    return exact(N.normalize_blocks(star.nested_blocks(), CHAIN))


@query("raw_tx_rows", "N2 N3 N8 X4 J13", LINES + f"""
SELECT 7 AS chain_id, {_W32("key * 2 + i")} AS hash, key AS block_number, {_W32("key")} AS block_hash, {_MS} AS block_time, i AS transaction_index, CAST(line + i AS VARCHAR) AS nonce,
       {_W20("part + i")} AS "from", CASE WHEN l_discount <> 0 THEN {_W20("supp")} END AS "to", {_W32("cents * (i + 1)")} AS value, 30000 AS gas_limit, CAST(cents + 25 AS VARCHAR) AS gas_price,
       qty * 100 + 21000 AS gas_used, l_linestatus = 'O' AS success, '0abc' AS input, CASE WHEN i = 1 THEN 2 ELSE 0 END AS type,
       CASE WHEN l_tax <> 0 THEN CAST(cents * 2 AS VARCHAR) END AS max_fee_per_gas, CASE WHEN l_tax <> 0 THEN CAST(20 + i AS VARCHAR) END AS max_priority_fee_per_gas,
       CASE WHEN l_tax <> 0 THEN CASE WHEN qty < 10 OR cents = 0 THEN '0' ELSE CAST(20 + i AS VARCHAR) END END AS priority_fee_per_gas, {_FEE} AS base_fee_per_gas,
       NULL::VARCHAR AS contract_address, CASE WHEN i = 1 THEN {_W20("supp")} || ':' || {_W32("part")} ELSE '' END AS access_list
FROM l, (VALUES (0), (1)) v(i)""")  # fmt: skip
def raw_tx_rows(star: Star):
    listed = F.transform("access_list", lambda a: F.concat(F.lower(F.hex(a["address"])), F.lit(":"), F.array_join(F.transform(a["storage_keys"], lambda k: F.lower(F.hex(k))), "+")))
    return exact(N.normalize_txs(N.tx_rows(star.nested_blocks(), CHAIN, parts=N.TX_PARTS)).withColumn("access_list", F.array_join(listed, ",")))


@query("raw_trace_rows", "N4 N5 U1", LINES + f"""
SELECT 7 AS chain_id, {_W32("key * 2")} AS tx_hash, key AS block_number, {_MS} AS block_time, 0 AS transaction_index, path AS trace_address,
       {_W20("CASE path WHEN '' THEN part WHEN '0.0' THEN supp + 1 ELSE supp END")} AS "from", {_W20("CASE path WHEN '' THEN supp WHEN '0' THEN 0 ELSE part END")} AS "to",
       CASE path WHEN '' THEN 16 WHEN '0' THEN 5 WHEN '0.0' THEN 4 ELSE 3 END AS gas, CASE path WHEN '' THEN 8 WHEN '0' THEN 0 WHEN '0.0' THEN 2 ELSE 1 END AS gas_used,
       {_W32("CASE path WHEN '' THEN 1 ELSE 0 END")} AS value, CASE path WHEN '0' THEN '01' ELSE '' END AS input, '' AS output,
       CASE path WHEN '' THEN 'CALL' WHEN '0' THEN 'CREATE' WHEN '0.0' THEN 'STATICCALL' ELSE 'CALL' END AS call_type, l_linestatus = 'O' AS tx_success, {_W20("part")} AS tx_from,
       CASE WHEN l_discount <> 0 THEN {_W20("supp")} END AS tx_to
FROM l, (VALUES (''), ('0'), ('0.0'), ('1')) v(path)""")  # fmt: skip
def raw_trace_rows(star: Star):
    t = N.normalize_traces(N.tx_rows(star.nested_blocks(), CHAIN, parts=N.TRACE_PARTS), each_tx=exact)
    return exact(t.withColumn("trace_address", F.array_join(F.transform("trace_address", lambda x: x.cast("string")), ".")))


@query("raw_log_rows", "N6 S3", LINES + f"""
SELECT 7 AS chain_id, {_W20("supp + i")} AS address, key AS block_number, {_W32("key")} AS block_hash, {_MS} AS block_time, {_W32("key * 2 + i")} AS transaction_hash, i AS transaction_index,
       i AS log_index, {_W20("part + i")} AS tx_from, CASE WHEN l_discount <> 0 THEN {_W20("supp")} END AS tx_to, '{TRANSFER}' AS topic0, {_W32("part")} AS topic1, {_W32("ok")} AS topic2,
       NULL::VARCHAR AS topic3, {_W32("cents")} AS data, FALSE AS removed
FROM l, (VALUES (0), (1)) v(i)""")  # fmt: skip
def raw_log_rows(star: Star):
    return exact(N.normalize_logs(N.tx_rows(star.nested_blocks(), CHAIN)))


# --- sources and status ---------------------------------------------------------------------


@query("platform_files", "S4 N10 N11", CATALOG["platform_transactions"].sql)
def platform_files(star: Star):
    folder = f"{scratch(star.spark)}/platform"
    star.platform_blocks().write.json(folder)
    txs = read_platform_txs(star.spark, folder)
    return plain(txs.withColumn("subnet", X.json_field("tx_data", "subnetID")).drop("tx_data"))


@query("storage_per_billion", "S12 A10", """
SELECT (SELECT count(*) FROM orders) + (SELECT count(*) FROM lineitem) + (SELECT count(*) FROM events) AS total_rows, TRUE AS measured""")  # fmt: skip
def storage_per_billion(star: Star):
    stats = ST.table_stats(star.spark, {n: f"{star.folder}/{n}.parquet" for n in ("orders", "lineitem", "events")})
    per_tx = stats.where(F.col("table") == "lineitem").agg(F.sum("rows").alias("n"))
    gb = ST.gb_per_billion(stats, "lineitem").join(per_tx, how="full")
    same = F.abs(F.col("gb_per_billion") * F.col("n") * 2**30 / 1e9 - F.col("total_bytes")) < 1
    return gb.select("total_rows", (same & (F.col("total_bytes") > 0)).alias("measured"))


@query("chains_of_address", "B12 U4 F5", with_tables("raw_traces") + """
SELECT DISTINCT chain_id FROM (SELECT chain_id, sender AS a FROM raw_traces UNION ALL SELECT chain_id, recipient FROM raw_traces) WHERE a = 7""")  # fmt: skip
def chains_of_address(star: Star):
    return B.chains_of(B.address_on_chain(star.raw_traces()), f"{7:040x}")


@query("balance_accumulator_updates", "B13 V3", ENTRIES + """
, b AS (SELECT *, CASE WHEN block_number < 700 THEN 1 ELSE 2 END AS batch FROM entries WHERE wallet <> 0)
SELECT chain_id, max(CASE batch WHEN 1 THEN 699 ELSE 99999999 END) AS max_block, count(DISTINCT (wallet, token)) AS unique_pairs,
       strftime(make_timestamp(max(batch) * 3600000000), '%Y-%m-%d %H:%M:%S') AS last_update FROM b GROUP BY 1""")  # fmt: skip
def balance_accumulator_updates(star: Star):
    batches = ((F.col("block_number") < 700, 699, 1), (F.col("block_number") >= 700, 99999999, 2))
    rows = [B.accumulated(star.token_logs().where(c), last).withColumn("computed_at", F.timestamp_seconds(F.lit(3600 * n))) for c, last, n in batches]
    return plain(B.accumulator_progress(rows[0].unionByName(rows[1])))


# --- display ----------------------------------------------------------------------------------

_LONG = " ".join(f"WHEN n < 1e{p + 3} THEN {_fixed(f'n / 1e{p}', 2)} || ' {name}'" for p, name in ((3, "thousand"), (6, "million"), (9, "billion"), (12, "trillion")))


@query("long_quantities", "X19", f"""
WITH v AS (SELECT o_orderkey, CAST(CAST(floor(o_totalprice) AS BIGINT) * CAST(pow(1000, o_orderkey % 4) AS BIGINT) AS DOUBLE) / 512 AS n FROM orders)
SELECT o_orderkey, CASE WHEN n < 1e3 THEN {_fixed("n", 2)} {_LONG} END AS long,
       CASE WHEN n < 1024 THEN {_fixed("n", 0)} || ' B' WHEN n < 1048576 THEN {_fixed("n / 1024", 2)} || ' KB' WHEN n < 1073741824 THEN {_fixed("n / 1048576", 2)} || ' MB'
            ELSE {_fixed("n / 1073741824", 2)} || ' GB' END AS bytes FROM v""")  # fmt: skip
def long_quantities(star: Star):
    n = F.floor("o_totalprice").cast("bigint") * F.pow(F.lit(1000), F.pmod("o_orderkey", F.lit(4))).cast("bigint") / F.lit(512.0)
    return star.table("orders").select("o_orderkey", X.readable_quantity(n).alias("long"), X.bytes_text(n).alias("bytes"))


@query("fields_by_name", "X22", f"""
WITH v AS (SELECT event_id, ['stakeAmount', 'startTime', 'endTime', 'memo', 'weight'][event_id % 5 + 1] AS name, event_id * 1000003 AS big, 1600000000 + event_id AS seconds FROM events),
     c AS (SELECT *, CAST(big AS DOUBLE) / 1e9 AS c FROM v)
SELECT event_id, name, CASE name
  WHEN 'stakeAmount' THEN CASE WHEN big <= 1000000 THEN CAST(big AS VARCHAR) WHEN c >= 1e6 THEN {_fixed("c / 1e6", 2)} || 'M' WHEN c >= 1e3 THEN {_fixed("c / 1e3", 2)} || 'K' WHEN c >= 1 THEN {_fixed("c", 2)} ELSE {_fixed("c", 4)} END
  WHEN 'startTime' THEN strftime(make_timestamp(seconds * 1000000), '%Y-%m-%d %H:%M:%S')
  WHEN 'endTime' THEN strftime(make_timestamp(seconds * 1000000), '%Y-%m-%d %H:%M:%S')
  WHEN 'memo' THEN 'm' || event_id ELSE CAST(event_id % 1000 AS VARCHAR) END AS shown FROM c""")  # fmt: skip
def fields_by_name(star: Star):
    event = F.col("event_id")
    turn = F.pmod(event, F.lit(5))
    name = F.get(F.array(*[F.lit(n) for n in ("stakeAmount", "startTime", "endTime", "memo", "weight")]), turn.cast("int"))
    value = (
        F.when(turn == 0, (event * 1000003).cast("string"))
        .when(turn == 1, (event + 1600000000).cast("string"))
        .when(turn == 2, ((event + 1600000000) * 1000 + 7).cast("string"))
        .when(turn == 3, F.concat(F.lit("m"), event.cast("string")))
        .otherwise(F.pmod(event, F.lit(1000)).cast("string"))
    )
    return star.table("events").select("event_id", name.alias("name"), value.alias("value")).select("event_id", "name", X.field_display("name", "value").alias("shown"))


# --- estimates: within three standard errors of the exact count ---------------------------------

_TOLERANCE = 0.15


def _near(estimate: str, truth: str) -> Column:
    return F.abs(F.col(estimate) - F.col(truth)) <= F.greatest(F.lit(1.0), F.col(truth) * _TOLERANCE)


def _beside_null_safe(a: DataFrame, b: DataFrame) -> DataFrame:
    """Aggregates of the same groups side by side; null is a group too."""
    return a.join(b.withColumnRenamed("l_linenumber", "_same"), F.col("l_linenumber").eqNullSafe(F.col("_same"))).drop("_same")


@query("agg_distinct_estimate_bounds", "A2 A3 A4", "SELECT DISTINCT l_linenumber, TRUE AS parts, TRUE AS pairs FROM lineitem")
def agg_distinct_estimate_bounds(star: Star):
    # each count is an aggregation of its own: beside exact counts every distinct value would carry the sketches through the shuffle
    groups = star.table("lineitem").groupBy("l_linenumber")
    counts = [
        groups.agg(A.distinct_count("l_partkey", approx=True).alias("p"), A.distinct_count("l_partkey", "l_suppkey", approx=True).alias("q")),
        groups.agg(A.distinct_count("l_partkey").alias("p1")), groups.agg(A.distinct_count("l_partkey", "l_suppkey").alias("q1")),
    ]
    rows = reduce(_beside_null_safe, counts)
    return plain(rows.select("l_linenumber", _near("p", "p1").alias("parts"), _near("q", "q1").alias("pairs")))


_ENDS = """
, made AS (SELECT * FROM raw_traces WHERE call_type IN ('CREATE', 'CREATE2') AND tx_success)
, seen AS (SELECT 'active_addresses' AS metric_name, chain_id, block_time, sender AS a FROM raw_traces UNION ALL SELECT 'active_addresses', chain_id, block_time, recipient FROM raw_traces
  UNION ALL SELECT 'active_senders', chain_id, block_time, sender FROM raw_traces UNION ALL SELECT 'deployers', chain_id, block_time, sender FROM made)
"""


@query("active_addresses_estimate_bounds", "M10 M11 M13 A2", with_tables("raw_traces") + _ENDS + " UNION ALL ".join(
    f"SELECT DISTINCT chain_id, metric_name, '{g}' AS granularity, {text_time(period_sql('block_time', g))} AS period, TRUE AS near FROM seen WHERE a <> 0" for g in GRANULARITIES))
def active_addresses_estimate_bounds(star: Star):
    names, keys = ["active_addresses", "active_senders", "deployers"], ["chain_id", "metric_name", "granularity", "period"]
    estimate, truth = [M.metric_batch(_tables(star), names, approx=a).select(*keys, F.col("value").cast("double").alias(n)) for a, n in ((True, "estimate"), (False, "truth"))]
    return plain(estimate.join(truth, keys, "full").select(*keys, F.coalesce(_near("estimate", "truth"), F.lit(False)).alias("near")))


# --- pages of one platform chain of two ------------------------------------------------------------


def _beside(df: DataFrame, *renamed: str) -> DataFrame:
    """The rows as platform chain 0, and again as chain 1 with other names in the ``renamed`` columns."""
    other = df.withColumns({c: F.concat(F.lit("other-"), F.col(c)) for c in renamed}).withColumn("p_chain_id", F.lit(1).cast("bigint"))
    return df.withColumn("p_chain_id", F.lit(0).cast("bigint")).unionByName(other)


def _txs_of_two(star: Star) -> DataFrame:
    """Chain 1 has the transactions of even blocks alone."""
    even = star.platform_txs().where("block_number % 2 = 0").withColumn("p_chain_id", F.lit(1).cast("bigint"))
    return star.platform_txs().unionByName(even)


@query("platform_stats_of_chain", "Q-5", CATALOG["platform_stats"].sql)
def platform_stats_of_chain(star: Star):
    state, subnets = _beside(platform._state(star), "subnet_id", "node_id"), _beside(platform._subnets(star), "subnet_id")
    return plain(Q.platform_stats(state, subnets, _txs_of_two(star), _beside(platform._fees(star), "subnet_id"), platform.AS_OF, p_chain_id=0))


@query("tx_type_activity_of_chain", "Q-7 K2", CATALOG["tx_type_activity"].sql.replace("GROUP BY 1", "AND block_number % 2 = 0 GROUP BY 1"))
def tx_type_activity_of_chain(star: Star):
    return Q.tx_type_activity(_txs_of_two(star), platform.AS_OF, days=1000, p_chain_id=1)


@query("recent_blocks_of_chain", "Q-9 A5 X7", CATALOG["recent_blocks"].sql.replace("GROUP BY 1", "AND block_number % 2 = 0 GROUP BY 1"))
def recent_blocks_of_chain(star: Star):
    return Q.recent_blocks(_txs_of_two(star), "2000-01-02", p_chain_id=1)


@query("recent_txs_of_chain", "Q-10 K3", CATALOG["recent_txs"].sql.replace("ORDER BY", "AND block_number % 2 = 0 ORDER BY"))
def recent_txs_of_chain(star: Star):
    return Q.recent_txs(_txs_of_two(star), "2000-01-02", p_chain_id=1)
