"""Platform chain: sources, lifecycle, deposits, refunds, fees, and its pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockloom.catalog import plain, query
from blockloom.operators import normalize as N
from blockloom.plans import dashboards as Q
from blockloom.plans import platform as L
from blockloom.session import cut_lineage, scratch
from blockloom.sources.platform import platform_txs, registry, validator_state
from blockloom.sources.star_schema import Star, with_tables

AS_OF = "2001-09-01 00:00:00"
NOW = f"TIMESTAMP '{AS_OF}'"
TIME = "strftime({}, '%Y-%m-%d %H:%M:%S')".format
NODE = "'NodeID-{}-' || lpad(CAST({} AS VARCHAR), 26, '1')".format

# Building blocks of the expected results, straight from the source columns.
_PARTS = {
    "listed": """SELECT tx_id, subnet_id, i AS ordinal, 'NodeID-' || i || '-' || lpad(CAST(cust AS VARCHAR), 26, '1') AS node_id, 'val' || i || 'x' || cust AS validation_id, block_number, block_time,
       cents * 1000 * i AS balance, cents + i AS weight, '0xb' || block_number AS bls, 'P-' || cust AS owner FROM platform_txs, (VALUES (0), (1)) v(i) WHERE kind = 1""",
    "history": """SELECT subnet_id, node_id, validation_id, tx_id AS created_tx_id, 'ConvertSubnetToL1' AS created_tx_type, block_number AS created_block, block_time AS created_time,
       balance AS initial_balance, weight AS initial_weight, bls AS bls_public_key, owner AS remaining_balance_owner FROM listed
  UNION ALL SELECT subnet_id, 'NodeID-2-' || lpad(CAST(cust AS VARCHAR), 26, '1'), 'val2x' || cust || '-' || block_number, tx_id, 'RegisterL1Validator', block_number, block_time,
       cents * 100, cents, '0xc' || block_number, 'P-' || cust FROM platform_txs WHERE kind = 6""",
    "state": """SELECT 'subnet' || c_custkey AS subnet_id, CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN 'val1x' || c_custkey ELSE 'stake' || c_custkey END AS validation_id,
       'NodeID-1-' || lpad(CAST(c_custkey AS VARCHAR), 26, '1') AS node_id, CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN greatest(CAST(round(c_acctbal * 100) AS BIGINT), 0) ELSE 0 END AS balance,
       abs(CAST(round(c_acctbal * 100) AS BIGINT)) + 1 AS weight, make_timestamp((1500000000 + c_custkey * 1000) * 1000000) AS start_time, make_timestamp((1800000000 + c_custkey) * 1000000) AS end_time,
       c_custkey % 100 + 0.5 AS uptime, NOT (c_mktsegment <> 'HOUSEHOLD' AND CAST(round(c_acctbal * 100) AS BIGINT) <= 0) AS active FROM customer""",
    "subnets": """SELECT subnet_id, min(block_number) AS created_block, arg_min(block_time, block_number) AS created_time,
       CASE arg_max(kind, block_number) FILTER (WHERE kind IN (1, 5)) WHEN 1 THEN 'l1' WHEN 5 THEN 'elastic' ELSE 'regular' END AS subnet_type,
       coalesce(max('chain' || cust) FILTER (WHERE kind = 1), '') AS chain_id, coalesce(max(block_number) FILTER (WHERE kind IN (1, 5)), 0) AS converted_block,
       coalesce(arg_max(block_time, block_number) FILTER (WHERE kind IN (1, 5)), TIMESTAMP '1970-01-01') AS converted_time
  FROM platform_txs WHERE kind IN (0, 1, 4, 5) GROUP BY 1""",
    "ledger": """SELECT s.validation_id, t.tx_id, 'IncreaseL1ValidatorBalance' AS tx_type, t.block_number, t.block_time, t.cents * 100 AS amount, s.subnet_id, s.node_id
  FROM platform_txs t JOIN state s ON s.validation_id = 'val1x' || t.cust WHERE t.kind = 2
  UNION ALL SELECT validation_id, created_tx_id, created_tx_type, created_block, created_time, initial_balance, subnet_id, node_id FROM history WHERE initial_balance > 0""",
    "spans": """SELECT d.tx_id, 'val1x' || d.cust AS validation_id, d.block_number, d.block_time,
       max(d.block_time) OVER (PARTITION BY d.cust ORDER BY d.block_time RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 SECOND PRECEDING) AS previous, h.subnet_id AS h_subnet, h.owner, h.created_time, s.subnet_id AS s_subnet, s.start_time
  FROM platform_txs d
  LEFT JOIN (SELECT validation_id, arg_min(subnet_id, created_block) AS subnet_id, arg_min(remaining_balance_owner, created_block) AS owner, arg_min(created_time, created_block) AS created_time FROM history GROUP BY 1) h
    ON h.validation_id = 'val1x' || d.cust
  LEFT JOIN state s ON s.validation_id = 'val1x' || d.cust WHERE d.kind = 3""",
    "refunds": """SELECT tx_id, validation_id, subnet_id, refund_address, block_number, block_time, deposits - 512 * greatest(CAST(epoch(block_time) - epoch(since) AS BIGINT), 0) AS refund_amount
  FROM (SELECT p.tx_id, p.validation_id, coalesce(h_subnet, s_subnet) AS subnet_id, coalesce(owner, '') AS refund_address, p.block_number, p.block_time, coalesce(previous, created_time, start_time) AS since,
       coalesce(sum(l.amount), 0) AS deposits
    FROM spans p LEFT JOIN ledger l ON l.validation_id = p.validation_id AND l.block_time <= p.block_time
      AND CASE WHEN previous IS NOT NULL THEN l.block_time > previous ELSE l.block_time >= coalesce(created_time, start_time) END
    WHERE coalesce(h_subnet, s_subnet) IS NOT NULL GROUP BY 1, 2, 3, 4, 5, 6, 7)""",
    "fees": """SELECT x.subnet_id, coalesce(d.total, 0) AS total_deposited, coalesce(d.first, 0) AS initial_deposits, coalesce(d.more, 0) AS top_up_deposits, coalesce(r.back, 0) AS total_refunded,
       coalesce(b.held, 0) AS current_balance, greatest(coalesce(d.total, 0) - coalesce(r.back, 0) - coalesce(b.held, 0), 0) AS total_fees_paid, coalesce(d.n, 0) AS deposit_tx_count, coalesce(d.v, 0) AS validator_count
  FROM (SELECT subnet_id FROM subnets WHERE subnet_type = 'l1') x
  LEFT JOIN (SELECT subnet_id, sum(amount) AS total, sum(amount) FILTER (WHERE tx_type <> 'IncreaseL1ValidatorBalance') AS first, sum(amount) FILTER (WHERE tx_type = 'IncreaseL1ValidatorBalance') AS more,
       count(*) AS n, count(*) FILTER (WHERE tx_type <> 'IncreaseL1ValidatorBalance') AS v FROM ledger GROUP BY 1) d ON d.subnet_id = x.subnet_id
  LEFT JOIN (SELECT subnet_id, sum(refund_amount) AS back FROM refunds WHERE refund_amount > 0 GROUP BY 1) r ON r.subnet_id = x.subnet_id
  LEFT JOIN (SELECT subnet_id, sum(balance) AS held FROM state GROUP BY 1) b ON b.subnet_id = x.subnet_id""",
    "registry": """SELECT 'subnet' || s_suppkey AS subnet_id, s_name AS name, CASE WHEN s_suppkey % 2 = 0 THEN 'about ' || s_name ELSE '' END AS description, 'logo' || s_suppkey AS logo_url FROM supplier WHERE s_suppkey % 10 <> 9""",
}
_NEEDS = {
    "listed": [], "history": ["listed"], "state": [], "subnets": [], "ledger": ["history", "state"], "spans": ["history", "state"],
    "refunds": ["spans", "ledger"], "fees": ["subnets", "refunds", "ledger", "state"], "registry": [],
}


def parts(*names: str) -> str:
    order: list[str] = []

    def add(n: str) -> None:
        for need in _NEEDS[n]:
            add(need)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    return with_tables("platform_txs") + "".join(f",\n{n} AS ({_PARTS[n]})" for n in order) + "\n"


def _once(star: Star, name: str, make):
    """Tables that several steps read are materialised once per run, as a sync cycle writes them."""
    kept = star.__dict__.setdefault("_tables", {})
    if name not in kept:
        kept[name] = cut_lineage(make())
    return kept[name]


def _state(star: Star):
    return _once(star, "state", lambda: validator_state(star.snapshot(), 0, F.lit(AS_OF).cast("timestamp")))


def _txs(star: Star):
    return _once(star, "txs", lambda: star.platform_txs().where(F.col("tx_type").isin(*L.USED_TYPES)))


def _history(star: Star):
    return _once(star, "history", lambda: L.validator_history(_txs(star), star.registrations(), AS_OF))


def _ledger(star: Star):
    return _once(star, "ledger", lambda: L.balance_ledger(_txs(star), _state(star), _history(star)))


def _refunds(star: Star):
    return _once(star, "refunds", lambda: L.refunds(_txs(star), _ledger(star), _history(star), _state(star)))


def _subnets(star: Star):
    return _once(star, "subnets", lambda: L.all_subnets(_txs(star), AS_OF))


def _fees(star: Star):
    return _once(star, "fees", lambda: L.subnet_fee_stats(_ledger(star), _refunds(star), _state(star), _subnets(star), AS_OF))


def _registry(star: Star):
    return registry(star.registry_entries(), F.lit(AS_OF).cast("timestamp"))


# --- sources -----------------------------------------------------------------------------------


@query("platform_transactions", "S4 N10 N11 W6 X17", with_tables("platform_txs") + f"""
, times AS (SELECT *, CASE WHEN block_number % 5 <> 3 THEN block_time END AS own, CASE WHEN kind = 7 THEN block_time END AS advance FROM platform_txs)
, known AS (SELECT *, last_value(advance IGNORE NULLS) OVER (ORDER BY block_number RANGE BETWEEN 100 PRECEDING AND CURRENT ROW) AS k FROM times)
SELECT tx_id, tx_type, block_number, {TIME("coalesce(own, k, make_timestamp((1600646400 + 2 * block_number) * 1000000))")} AS block_time, 0 AS p_chain_id, CASE WHEN kind IN (0, 1, 4, 5) THEN subnet_id END AS subnet
FROM known""")  # fmt: skip
def platform_transactions(star: Star):
    txs = platform_txs(star.platform_blocks(), 0)
    return plain(txs.withColumn("subnet", L.json_field("tx_data", "subnetID")).drop("tx_data"))


@query("platform_fields", "N9 X17", with_tables("platform_txs") + f"""
SELECT tx_id, tx_type, CASE WHEN kind IN (0, 1, 4, 5) THEN subnet_id END AS subnet_id, CASE WHEN kind = 1 THEN 'chain' || cust END AS chain_id, CASE WHEN kind = 0 THEN 'Chain ' || block_number END AS chain_name,
       CASE WHEN kind = 4 THEN {NODE(1, "cust")} END AS node_id, CASE WHEN kind = 4 THEN CAST(block_number + 1600000000 AS VARCHAR) END AS start_time, CASE WHEN kind = 4 THEN CAST(cents AS VARCHAR) END AS weight,
       CASE WHEN kind = 2 THEN 'val1x' || cust END AS validation_id, CASE WHEN kind = 2 THEN CAST(cents * 100 AS VARCHAR) END AS balance, CASE WHEN kind = 7 THEN CAST(CAST(epoch(block_time) AS BIGINT) AS VARCHAR) END AS time,
       CASE WHEN kind = 8 THEN 'X' END AS source_chain, CASE WHEN kind = 9 THEN 'C' END AS destination_chain FROM platform_txs""")  # fmt: skip
def platform_fields(star: Star):
    cols = ["tx_id", "tx_type", "subnet_id", "chain_id", "chain_name", "node_id", "start_time", "weight", "validation_id", "balance", "time", "source_chain", "destination_chain"]
    return plain(N.platform_tx_fields(star.platform_txs()).select(*cols))


@query("platform_validator_lists", "N12 X17", parts("listed") + "SELECT tx_id, subnet_id, ordinal, node_id, CAST(balance AS VARCHAR) AS balance FROM listed")
def platform_validator_lists(star: Star):
    rows = N.explode_validators(star.platform_txs().where("tx_type = 'ConvertSubnetToL1'"))
    v = lambda p: F.try_variant_get("validator", f"$.{p}", "string")
    return plain(rows.select("tx_id", "subnet_id", "ordinal", v("nodeID").alias("node_id"), v("balance").alias("balance")))


@query("registry_entries", "S5", parts("registry") + "SELECT subnet_id, name, description, logo_url, '' AS website_url FROM registry")
def registry_entries(star: Star):
    return _registry(star).drop("last_updated")


@query("validator_snapshot", "S6 L7 X16", parts("state") + f"""
SELECT subnet_id, validation_id, node_id, CAST(balance AS VARCHAR) AS balance, CAST(weight AS VARCHAR) AS weight, {TIME("start_time")} AS start_time, {TIME("end_time")} AS end_time, CAST(uptime AS DOUBLE) AS uptime_percentage, active FROM state""")  # fmt: skip
def validator_snapshot(star: Star):
    cols = ["subnet_id", "validation_id", "node_id", "balance", "weight", "start_time", "end_time", "uptime_percentage", "active"]
    return plain(_state(star).select(*cols))


# --- lifecycle ---------------------------------------------------------------------------------


@query("subnet_conversions", "L1 V1", with_tables("platform_txs") + f"""
SELECT subnet_id, CASE WHEN arg_max(kind, block_number) = 1 THEN 'chain' || any_value(cust) ELSE '' END AS chain_id, max(block_number) AS conversion_block, {TIME("arg_max(block_time, block_number)")} AS conversion_time, 0 AS p_chain_id
FROM platform_txs WHERE kind IN (1, 5) GROUP BY 1""")  # fmt: skip
def subnet_conversions(star: Star):
    return plain(L.subnet_conversions(star.platform_txs(), AS_OF).drop("last_synced"))


@query("all_subnets", "L2 V8", parts("subnets") + f"""
SELECT subnet_id, created_block, {TIME("created_time")} AS created_time, subnet_type, chain_id, converted_block, {TIME("converted_time")} AS converted_time FROM subnets""")  # fmt: skip
def all_subnets(star: Star):
    return plain(_subnets(star).drop("p_chain_id", "last_updated"))


@query("subnets_with_primary", "L3", parts("subnets") + """
SELECT subnet_type, count(*) AS n, min(created_block) AS first_block FROM (SELECT subnet_type, created_block FROM subnets UNION ALL SELECT 'primary', 0) GROUP BY 1""")  # fmt: skip
def subnets_with_primary(star: Star):
    primary, _ = L.genesis_rows(star.spark, 0, AS_OF)
    return _subnets(star).unionByName(primary).groupBy("subnet_type").agg(F.count("*").alias("n"), F.min("created_block").alias("first_block"))


@query("subnet_chains", "L4 J5 W4 L3", with_tables("platform_txs") + f"""
, c AS (SELECT DISTINCT 'chain' || cust AS chain_id, subnet_id FROM platform_txs WHERE kind = 1)
, f AS (SELECT subnet_id, min(block_number) AS b, arg_min(block_time, block_number) AS t FROM platform_txs WHERE kind = 0 GROUP BY 1)
SELECT c.chain_id, c.subnet_id, coalesce('Chain ' || b, '') AS chain_name, coalesce('vm' || b % 7, '') AS vm_id, coalesce(b, 0) AS created_block, {TIME("coalesce(t, TIMESTAMP '1970-01-01')")} AS created_time FROM c LEFT JOIN f ON c.subnet_id = f.subnet_id
UNION ALL SELECT x.c, '11111111111111111111111111111111LpoYY', x.n, x.v, 0, '2020-09-21 19:00:00' FROM (VALUES
 ('2q9e4r6Mu3U68nU1fYjgbR6JvwrRx36CohpAX5UQxse55x1Q5', 'C-Chain', 'mgj786NP7uDwBCcq6YwThhaN8FLyybkCa4zBWTQbNgmK6k9A6'), ('2oYMBNV4eNHyqk2fjjV5nVQLDbtmNJzq5s3qs3Lo6ftnC6FByM', 'X-Chain', 'avm'),
 ('11111111111111111111111111111111LpoYY', 'P-Chain', 'platform')) x(c, n, v)""")  # fmt: skip
def subnet_chains(star: Star):
    _, primary = L.genesis_rows(star.spark, 0, AS_OF)
    return plain(L.subnet_chains(star.platform_txs(), AS_OF).unionByName(primary).drop("p_chain_id", "last_updated"))


@query("validator_history", "L5 N12 J1", parts("history") + f"""
SELECT subnet_id, node_id, validation_id, created_tx_id, created_tx_type, created_block, {TIME("created_time")} AS created_time, CAST(initial_balance AS VARCHAR) AS initial_balance, CAST(initial_weight AS VARCHAR) AS initial_weight,
       bls_public_key, remaining_balance_owner FROM history""")  # fmt: skip
def validator_history(star: Star):
    return plain(_history(star).drop("p_chain_id", "last_updated"))


@query("legacy_subnets", "L6", parts("subnets") + "SELECT subnet_id, created_block FROM subnets WHERE subnet_type IN ('regular', 'elastic')")
def legacy_subnets(star: Star):
    return L.legacy_subnets(_subnets(star)).drop("p_chain_id")


@query("monitored_subnets", "L14 A7", with_tables("platform_txs") + "\nSELECT DISTINCT subnet_id FROM platform_txs WHERE kind IN (1, 5)")
def monitored_subnets(star: Star):
    return L.monitored_subnets(L.subnet_conversions(star.platform_txs(), AS_OF)).select("subnet_id")


@query("validators_gone", "L8 J8 V2", parts("state") + f"""
SELECT validation_id, node_id, FALSE AS active, '{AS_OF}' AS last_updated FROM state WHERE active AND weight % 3 = 0 AND weight % 2 = 0""")  # fmt: skip
def validators_gone(star: Star):
    # earlier state: every validator; the snapshot answers for subnets of even weight and lacks validators whose weight divides by 3
    state = _state(star).withColumn("last_updated", F.lit("2001-08-01").cast("timestamp"))
    weight = F.col("weight").cast("bigint")
    other = state.withColumn("validation_id", F.concat(F.lit("other"), F.col("validation_id")))
    snapshot = state.where(F.pmod(weight, F.lit(3)) != 0).unionByName(other).where(F.pmod(weight, F.lit(2)) == 0)
    return plain(L.mark_inactive(state, snapshot, AS_OF).select("validation_id", "node_id", "active", "last_updated"))


@query("balance_ledger", "L9 J1", parts("ledger") + f"""
SELECT validation_id, tx_id, tx_type, block_number, {TIME("block_time")} AS block_time, CAST(amount AS VARCHAR) AS amount, subnet_id, node_id FROM ledger""")  # fmt: skip
def balance_ledger(star: Star):
    return plain(_ledger(star).drop("p_chain_id"))


@query("validator_refunds", "L10 W7 J11 J12", parts("refunds") + f"""
SELECT tx_id, validation_id, subnet_id, CAST(refund_amount AS VARCHAR) AS refund_amount, refund_address, block_number, {TIME("block_time")} AS block_time FROM refunds WHERE refunds.refund_amount > 0""")  # fmt: skip
def validator_refunds(star: Star):
    return plain(_refunds(star).drop("p_chain_id"))


@query("subnet_fee_stats", "L11 J4 A1", parts("fees") + """
SELECT subnet_id, CAST(total_deposited AS VARCHAR) AS total_deposited, CAST(initial_deposits AS VARCHAR) AS initial_deposits, CAST(top_up_deposits AS VARCHAR) AS top_up_deposits, CAST(total_refunded AS VARCHAR) AS total_refunded,
       CAST(current_balance AS VARCHAR) AS current_balance, CAST(total_fees_paid AS VARCHAR) AS total_fees_paid, deposit_tx_count, validator_count FROM fees""")  # fmt: skip
def subnet_fee_stats(star: Star):
    return plain(_fees(star).drop("p_chain_id", "last_updated"))


VALIDATOR_FEES = parts("refunds") + """
, v AS (SELECT s.subnet_id, s.validation_id, s.node_id, s.balance, coalesce(i.b, 0) AS first, coalesce(t.b, 0) AS more, coalesce(r.b, 0) AS back FROM state s
  LEFT JOIN (SELECT validation_id, sum(initial_balance) AS b FROM history GROUP BY 1) i ON i.validation_id = s.validation_id
  LEFT JOIN (SELECT validation_id, sum(amount) AS b FROM ledger WHERE tx_type = 'IncreaseL1ValidatorBalance' GROUP BY 1) t ON t.validation_id = s.validation_id
  LEFT JOIN (SELECT validation_id, sum(refund_amount) AS b FROM refunds WHERE refund_amount > 0 GROUP BY 1) r ON r.validation_id = s.validation_id)
SELECT subnet_id, validation_id, node_id, CAST(first AS VARCHAR) AS initial_deposit, CAST(more AS VARCHAR) AS total_topups, CAST(back AS VARCHAR) AS refund_amount, CAST(greatest(first + more - back - balance, 0) AS VARCHAR) AS fees_paid FROM v"""


@query("validator_fee_stats", "L12 J4", VALIDATOR_FEES)
def validator_fee_stats(star: Star):
    rows = L.validator_fee_stats(_state(star), _history(star), _ledger(star), _refunds(star), AS_OF)
    return plain(rows.select("subnet_id", "validation_id", "node_id", "initial_deposit", "total_topups", "refund_amount", "fees_paid"))


@query("platform_cycle", "L13 T8", VALIDATOR_FEES)
def platform_cycle(star: Star):
    tables = L.run_platform_cycle(star.platform_txs(), _state(star), star.registrations(), None, AS_OF)
    return plain(tables["l1_validator_state"].select("subnet_id", "validation_id", "node_id", "initial_deposit", "total_topups", "refund_amount", "fees_paid"))


# --- the stored cycle ----------------------------------------------------------------------------

_MOVED = "c_custkey % 7 = 0 AND c_mktsegment <> 'HOUSEHOLD'"  # validators that are replaced before the second cycle
_TWO_CYCLES = {n: p for n, p in _PARTS.items()}
_TWO_CYCLES["state"] = f"""SELECT subnet_id, validation_id, node_id, balance, weight, start_time, end_time, uptime, active AND NOT moved AS active FROM (
  SELECT s.*, {_MOVED} AS moved FROM ({_PARTS["state"]}) s JOIN customer ON s.subnet_id = 'subnet' || c_custkey)
  UNION ALL SELECT subnet_id, 'new' || validation_id, node_id, balance, weight, start_time, end_time, uptime, active FROM ({_PARTS["state"]}) s JOIN customer ON s.subnet_id = 'subnet' || c_custkey WHERE {_MOVED}"""


def _cycle_sql(table: str, key: str, facts: list[str], source: str) -> str:
    text = ", ".join(f"coalesce(CAST({f} AS VARCHAR), '')" for f in facts)
    return f"SELECT '{table}' AS \"table\", {key} AS id, concat_ws('|', {text}) AS facts FROM {source}"


_CYCLE_FACTS = {
    "subnets": ("subnet_id", ["created_block", "subnet_type", "chain_id", "converted_block"]),
    "subnet_chains": ("chain_id", ["subnet_id", "chain_name", "vm_id", "created_block"]),
    "l1_subnets": ("subnet_id", ["chain_id", "conversion_block"]),
    "l1_validator_history": ("concat_ws('|', created_tx_id, node_id)", ["subnet_id", "validation_id", "created_tx_type", "created_block", "initial_balance", "initial_weight", "bls_public_key", "remaining_balance_owner"]),
    "l1_validator_balance_txs": ("concat_ws('|', tx_id, node_id)", ["subnet_id", "validation_id", "tx_type", "block_number", "amount"]),
    "l1_validator_refunds": ("tx_id", ["validation_id", "subnet_id", "refund_amount", "refund_address", "block_number"]),
    "l1_fee_stats": ("subnet_id", ["total_deposited", "initial_deposits", "top_up_deposits", "total_refunded", "current_balance", "total_fees_paid", "deposit_tx_count", "validator_count"]),
    "l1_validator_state": ("validation_id", ["subnet_id", "node_id", "balance", "weight", "active", "initial_deposit", "total_topups", "refund_amount", "fees_paid"]),
}
_CYCLE_SOURCES = {
    "subnets": "(SELECT * FROM subnets UNION ALL SELECT '11111111111111111111111111111111LpoYY', 0, NULL, 'primary', '', 0, NULL)",
    "subnet_chains": """(SELECT c.chain_id, c.subnet_id, coalesce('Chain ' || b, '') AS chain_name, coalesce('vm' || b % 7, '') AS vm_id, coalesce(b, 0) AS created_block
  FROM (SELECT DISTINCT 'chain' || cust AS chain_id, subnet_id FROM platform_txs WHERE kind = 1) c LEFT JOIN (SELECT subnet_id, min(block_number) AS b FROM platform_txs WHERE kind = 0 GROUP BY 1) f ON c.subnet_id = f.subnet_id
  UNION ALL SELECT x.c, '11111111111111111111111111111111LpoYY', x.n, x.v, 0 FROM (VALUES
 ('2q9e4r6Mu3U68nU1fYjgbR6JvwrRx36CohpAX5UQxse55x1Q5', 'C-Chain', 'mgj786NP7uDwBCcq6YwThhaN8FLyybkCa4zBWTQbNgmK6k9A6'), ('2oYMBNV4eNHyqk2fjjV5nVQLDbtmNJzq5s3qs3Lo6ftnC6FByM', 'X-Chain', 'avm'),
 ('11111111111111111111111111111111LpoYY', 'P-Chain', 'platform')) x(c, n, v))""",
    "l1_subnets": "(SELECT subnet_id, CASE WHEN arg_max(kind, block_number) = 1 THEN 'chain' || any_value(cust) ELSE '' END AS chain_id, max(block_number) AS conversion_block FROM platform_txs WHERE kind IN (1, 5) GROUP BY 1)",
    "l1_validator_history": "history",
    "l1_validator_balance_txs": "ledger",
    "l1_validator_refunds": "(SELECT * FROM refunds r WHERE r.refund_amount > 0)",
    "l1_fee_stats": "fees",
    "l1_validator_state": """(SELECT s.*, coalesce(i.b, 0) AS initial_deposit, coalesce(t.b, 0) AS total_topups, coalesce(r.b, 0) AS refund_amount, greatest(coalesce(i.b, 0) + coalesce(t.b, 0) - coalesce(r.b, 0) - s.balance, 0) AS fees_paid FROM state s
  LEFT JOIN (SELECT validation_id, sum(initial_balance) AS b FROM history GROUP BY 1) i ON i.validation_id = s.validation_id
  LEFT JOIN (SELECT validation_id, sum(amount) AS b FROM ledger WHERE tx_type = 'IncreaseL1ValidatorBalance' GROUP BY 1) t ON t.validation_id = s.validation_id
  LEFT JOIN (SELECT validation_id, sum(refund_amount) AS b FROM refunds WHERE refund_amount > 0 GROUP BY 1) r ON r.validation_id = s.validation_id)""",
}


def _cycle_parts() -> str:
    names = ["listed", "history", "state", "subnets", "ledger", "spans", "refunds", "fees"]
    return with_tables("platform_txs") + "".join(f",\n{n} AS ({_TWO_CYCLES[n]})" for n in names) + "\n"


@query("stored_platform_cycle", "L13 T8 V2 L8", _cycle_parts() + "\nUNION ALL ".join(_cycle_sql(t, *_CYCLE_FACTS[t], _CYCLE_SOURCES[t]) for t in L.PLATFORM_TABLES))
def stored_platform_cycle(star: Star):
    """All eight stored tables after two cycles; before the second, each seventh subnet's validator is replaced by another."""
    spark, root = star.spark, scratch(star.spark)
    first, second = (validator_state(star.snapshot(), 0, F.lit(t).cast("timestamp")) for t in ("2001-08-31 00:00:00", AS_OF))
    number = F.substring("subnet_id", 7, 20).cast("bigint")
    moved = (number % 7 == 0) & F.col("validation_id").startswith("val")
    second = second.withColumn("validation_id", F.when(moved, F.concat(F.lit("new"), F.col("validation_id"))).otherwise(F.col("validation_id")))
    L.store_platform_cycle(spark, root, star.platform_txs(), first, star.registrations(), "2001-08-31 00:00:00")
    tables = L.store_platform_cycle(spark, root, star.platform_txs(), second, star.registrations(), AS_OF)
    out = []
    for name, (key, facts) in _CYCLE_FACTS.items():
        text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in facts]
        out.append(tables[name].select(F.lit(name).alias("table"), F.expr(key).alias("id"), F.concat_ws("|", *text).alias("facts")))
    return reduce(DataFrame.unionByName, out)


@query("subnet_of_validation", "J12", parts("history", "state") + """
SELECT 'val1x' || o_custkey AS validation_id, o_orderkey, coalesce(h.s, t.s) AS subnet_id FROM orders
LEFT JOIN (SELECT validation_id, min(subnet_id) AS s FROM history GROUP BY 1) h ON h.validation_id = 'val1x' || o_custkey LEFT JOIN (SELECT validation_id, min(subnet_id) AS s FROM state GROUP BY 1) t ON t.validation_id = 'val1x' || o_custkey""")  # fmt: skip
def subnet_of_validation(star: Star):
    rows = star.table("orders").select(F.concat(F.lit("val1x"), F.col("o_custkey").cast("string")).alias("validation_id"), "o_orderkey")
    return L.subnet_of_validation(rows, _history(star), _state(star))


# --- pages ---------------------------------------------------------------------------------------


@query("platform_stats", "Q-5 A11 J2 F8", parts("fees") + f"""
SELECT CAST((SELECT count(DISTINCT s.subnet_id) FROM state s JOIN subnets n ON s.subnet_id = n.subnet_id WHERE active AND subnet_type = 'l1') AS VARCHAR) AS active_l1_subnets,
 CAST((SELECT count(DISTINCT s.subnet_id) FROM state s JOIN subnets n ON s.subnet_id = n.subnet_id WHERE active AND subnet_type = 'regular') AS VARCHAR) AS active_legacy_subnets,
 CAST((SELECT count(DISTINCT s.subnet_id) FROM state s JOIN subnets n ON s.subnet_id = n.subnet_id WHERE active AND subnet_type IN ('l1', 'regular', 'primary')) AS VARCHAR) AS active_chains,
 CAST((SELECT count(DISTINCT s.node_id) FROM state s JOIN subnets n ON s.subnet_id = n.subnet_id WHERE active AND subnet_type IN ('l1', 'primary')) AS VARCHAR) AS active_validators,
 CAST((SELECT count(*) FROM platform_txs WHERE block_time >= {NOW} - INTERVAL 7 DAY) AS VARCHAR) AS recent_transactions, CAST((SELECT sum(total_fees_paid) FROM fees) AS VARCHAR) AS total_l1_fees_paid""")  # fmt: skip
def platform_stats(star: Star):
    return plain(Q.platform_stats(_state(star), _subnets(star), star.platform_txs(), _fees(star), AS_OF))


@query("conversion_timeline", "Q-6 W3 P1 X13", parts("subnets") + """
SELECT period, CAST(sum(n) OVER (ORDER BY period) AS BIGINT) AS value FROM (SELECT strftime(date_trunc('month', converted_time), '%Y-%m-%d') AS period, count(*) AS n FROM subnets WHERE subnet_type = 'l1' GROUP BY 1)""")  # fmt: skip
def conversion_timeline(star: Star):
    return Q.conversion_timeline(_subnets(star))


@query("tx_type_activity", "Q-7 K2", with_tables("platform_txs") + f"""
SELECT tx_type, count(*) AS count FROM platform_txs WHERE block_time >= {NOW} - INTERVAL 1000 DAY GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")  # fmt: skip
def tx_type_activity(star: Star):
    return Q.tx_type_activity(star.platform_txs(), AS_OF, days=1000)


@query("subnet_table", "Q-8 J3 K4 X15", parts("fees", "registry") + f"""
SELECT n.subnet_id, subnet_type, chain_id, created_block, {TIME("created_time")} AS created_time, converted_block AS conversion_block, {TIME("converted_time")} AS conversion_time, coalesce(v.c, 0) AS validator_count, r.name, r.logo_url,
       CAST(coalesce(f.total_fees_paid, 0) AS VARCHAR) AS total_fees_paid FROM subnets n LEFT JOIN registry r ON n.subnet_id = r.subnet_id
LEFT JOIN (SELECT subnet_id, count(*) AS c FROM state WHERE active GROUP BY 1) v ON v.subnet_id = n.subnet_id LEFT JOIN fees f ON f.subnet_id = n.subnet_id""")  # fmt: skip
def subnet_table(star: Star):
    return plain(Q.subnet_table(_subnets(star), _registry(star), _state(star), _fees(star)))


@query("recent_blocks", "Q-9 A5 X7", with_tables("platform_txs") + """
SELECT block_number, CAST(epoch(max(block_time)) AS BIGINT) AS timestamp, count(*) AS tx_count, substr(min(tx_id), 1, 12) AS block_hash FROM platform_txs WHERE block_time >= TIMESTAMP '2000-01-02' - INTERVAL 1 DAY GROUP BY 1 ORDER BY 1 DESC LIMIT 8""")  # fmt: skip
def recent_blocks(star: Star):
    return Q.recent_blocks(star.platform_txs(), "2000-01-02")


@query("recent_txs", "Q-10 K3", with_tables("platform_txs") + """
SELECT tx_id, tx_type, strftime(block_time, '%Y-%m-%dT%H:%M:%SZ') AS formatted_time, block_number FROM platform_txs WHERE block_time >= TIMESTAMP '2000-01-02' - INTERVAL 1 DAY ORDER BY platform_txs.block_time DESC, tx_id LIMIT 8""")  # fmt: skip
def recent_txs(star: Star):
    return Q.recent_txs(star.platform_txs(), "2000-01-02")


_DETAILS = """
SELECT n.subnet_id, subnet_type, chain_id, converted_block AS conversion_block, strftime(converted_time, '%Y-%m-%d %H:%M:%S') AS conversion_time, coalesce(h.c, 0) AS validator_count, CAST(CAST(coalesce(w.s, 0) AS BIGINT) AS VARCHAR) AS total_weight,
       r.name, nullif(r.description, '') AS description, r.logo_url, NULL::VARCHAR AS website_url FROM subnets n
LEFT JOIN (SELECT subnet_id, count(DISTINCT node_id) AS c FROM history WHERE length(node_id) > 30 GROUP BY 1) h ON h.subnet_id = n.subnet_id
LEFT JOIN (SELECT subnet_id, sum(weight) AS s FROM state WHERE active AND length(node_id) > 30 GROUP BY 1) w ON w.subnet_id = n.subnet_id LEFT JOIN registry r ON r.subnet_id = n.subnet_id"""


@query("subnet_details", "Q-11 J10 F7", parts("subnets", "history", "state", "registry") + _DETAILS)
def subnet_details(star: Star):
    return plain(Q.subnet_details(_subnets(star), _registry(star), _state(star), _history(star)))


@query("subnet_details_of_one", "Q-11 F11", parts("subnets", "history", "state", "registry") + _DETAILS + " WHERE n.subnet_id = 'subnet42'")
def subnet_details_of_one(star: Star):
    return plain(Q.subnet_details(_subnets(star), _registry(star), _state(star), _history(star), "subnet42"))


@query("stake_validators", "Q-12", parts("state") + f"""
SELECT subnet_id, validation_id, node_id, CAST(weight AS VARCHAR) AS weight, CAST(weight AS VARCHAR) AS balance, {TIME("start_time")} AS start_time, {TIME("end_time")} AS end_time, CAST(uptime AS DOUBLE) AS uptime_percentage, active, '{AS_OF}' AS last_updated FROM state""")  # fmt: skip
def stake_validators(star: Star):
    return plain(Q.stake_validators(_state(star)))


_BURN = """CASE WHEN date_diff('day', {start}, {now}) > 0 AND {first} > {balance} THEN CAST({first} - {balance} AS DOUBLE) / date_diff('day', {start}, {now}) ELSE 0.0 END AS daily_burn_rate,
       CASE WHEN date_diff('day', {start}, {now}) > 0 AND {first} > {balance} THEN CAST({balance} AS DOUBLE) / (CAST({first} - {balance} AS DOUBLE) / date_diff('day', {start}, {now})) ELSE 0.0 END AS days_until_empty""".format
_LATER = "TIMESTAMP '2019-01-01 00:00:00'"


@query("l1_validators", "Q-13 J3 J7 U3 K5 X14", parts("history", "state") + f"""
, h AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY subnet_id, node_id ORDER BY created_block DESC, created_tx_id DESC) AS rn FROM history) WHERE rn = 1)
SELECT s.subnet_id, s.validation_id, s.node_id, CAST(weight AS VARCHAR) AS weight, CAST(balance AS VARCHAR) AS balance, {TIME("start_time")} AS start_time, {TIME("end_time")} AS end_time, CAST(uptime AS DOUBLE) AS uptime_percentage, active, '{AS_OF}' AS last_updated,
       created_tx_type, created_tx_id, created_block, {TIME("created_time")} AS created_time, CAST(initial_balance AS VARCHAR) AS initial_balance, CAST(initial_weight AS VARCHAR) AS initial_weight, bls_public_key,
       CAST(coalesce(initial_balance, 0) AS VARCHAR) AS initial_deposit, '0' AS total_topups, CAST(balance AS VARCHAR) AS refund_amount, CAST(greatest(coalesce(initial_balance, 0) - balance, 0) AS VARCHAR) AS fees_paid,
       {_BURN(start="start_time", now=_LATER, first="coalesce(initial_balance, 0)", balance="balance")}
FROM state s LEFT JOIN h ON h.subnet_id = s.subnet_id AND h.node_id = s.node_id
UNION ALL
SELECT subnet_id, '', node_id, CAST(initial_weight AS VARCHAR), '0', {TIME("created_time")}, '1970-01-01 00:00:00', 0.0, FALSE, {TIME("created_time")}, created_tx_type, created_tx_id, created_block, {TIME("created_time")}, CAST(initial_balance AS VARCHAR),
       CAST(initial_weight AS VARCHAR), bls_public_key, CAST(initial_balance AS VARCHAR), '0', '0', CAST(initial_balance AS VARCHAR), 0.0, 0.0
FROM h WHERE NOT EXISTS (SELECT 1 FROM state s WHERE s.subnet_id = h.subnet_id AND s.node_id = h.node_id)""")  # fmt: skip
def l1_validators(star: Star):
    return plain(Q.l1_validators(_state(star), _history(star), None, "2019-01-01"))


@query("validator_details", "Q-14 J6", parts("history", "state") + f"""
, h AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY subnet_id, node_id ORDER BY created_block, created_tx_id) AS rn FROM history) WHERE rn = 1)
SELECT coalesce(nullif(s.validation_id, ''), nullif(h.validation_id, ''), '') AS validation_id, coalesce(s.node_id, h.node_id) AS node_id, coalesce(s.subnet_id, h.subnet_id) AS subnet_id, CAST(coalesce(weight, initial_weight, 0) AS VARCHAR) AS weight,
       CAST(coalesce(balance, 0) AS VARCHAR) AS balance, {TIME("coalesce(start_time, created_time)")} AS start_time, {TIME("coalesce(end_time, TIMESTAMP '1970-01-01')")} AS end_time, CAST(coalesce(uptime, 0) AS DOUBLE) AS uptime_percentage,
       coalesce(active, FALSE) AS active, CASE WHEN s.node_id IS NOT NULL THEN '{AS_OF}' ELSE {TIME("created_time")} END AS last_updated, created_tx_type, created_tx_id, created_block, {TIME("created_time")} AS created_time,
       CAST(coalesce(initial_balance, 0) AS VARCHAR) AS initial_balance, CAST(coalesce(initial_weight, 0) AS VARCHAR) AS initial_weight, bls_public_key, CAST(coalesce(initial_balance, 0) AS VARCHAR) AS initial_deposit,
       CAST(greatest(coalesce(initial_balance, 0) - coalesce(balance, 0), 0) AS VARCHAR) AS fees_paid, {_BURN(start="start_time", now=_LATER, first="coalesce(initial_balance, 0)", balance="balance")}
FROM state s FULL OUTER JOIN h ON h.subnet_id = s.subnet_id AND h.node_id = s.node_id""")  # fmt: skip
def validator_details(star: Star):
    return plain(Q.validator_details(_state(star), _history(star), "2019-01-01"))


_LEDGER_ROWS = f"""
SELECT validation_id, tx_id, tx_type, block_number AS block_height, {TIME("block_time")} AS block_time, CAST(amount AS VARCHAR) AS amount, '' AS refund_address, CASE WHEN tx_type = 'IncreaseL1ValidatorBalance' THEN 'top-up' ELSE 'deposit' END AS effect FROM ledger
UNION ALL SELECT validation_id, tx_id, 'DisableL1Validator', block_number, {TIME("block_time")}, CAST(refund_amount AS VARCHAR), refund_address, 'refund' FROM refunds WHERE refund_amount > 0"""


@query("validator_ledger", "Q-15 K7", parts("refunds") + _LEDGER_ROWS)
def validator_ledger(star: Star):
    return plain(Q.validator_ledger(_ledger(star), _refunds(star)))


@query("ledger_totals", "Q-15 A10", parts("refunds") + f"""
, l AS ({_LEDGER_ROWS})
, t AS (SELECT validation_id, coalesce(sum(CAST(amount AS HUGEINT)) FILTER (WHERE effect = 'deposit'), 0) AS a, coalesce(sum(CAST(amount AS HUGEINT)) FILTER (WHERE effect = 'top-up'), 0) AS b, coalesce(sum(CAST(amount AS HUGEINT)) FILTER (WHERE effect = 'refund'), 0) AS c,
        count(*) FILTER (WHERE effect = 'refund') AS n FROM l GROUP BY 1)
SELECT t.validation_id, CAST(a AS VARCHAR) AS initial_deposit, CAST(b AS VARCHAR) AS total_topups, CAST(c AS VARCHAR) AS refund_amount, CAST(coalesce(balance, 0) AS VARCHAR) AS current_balance, CAST(a + b AS VARCHAR) AS total_funded,
       CAST(greatest(a + b - CASE WHEN n > 0 THEN c ELSE coalesce(balance, 0) END, 0) AS VARCHAR) AS fees_paid FROM t LEFT JOIN state s ON s.validation_id = t.validation_id""")  # fmt: skip
def ledger_totals(star: Star):
    return plain(Q.ledger_totals(Q.validator_ledger(_ledger(star), _refunds(star)), _state(star)))


@query("block_details", "Q-16 A5", with_tables("platform_txs") + """
SELECT block_number, count(*) AS tx_count, strftime(max(block_time), '%Y-%m-%dT%H:%M:%SZ') AS block_time, min(tx_id) AS block_hash, NULL::VARCHAR AS parent_id, NULL::VARCHAR AS proposer_id, NULL::VARCHAR AS proposer_node_id, min(tx_type) AS block_type FROM platform_txs GROUP BY 1""")  # fmt: skip
def block_details(star: Star):
    return Q.block_details(star.platform_txs())


@query("block_transactions", "Q-16 F11 X23", with_tables("platform_txs") + """
SELECT tx_id, tx_type, strftime(block_time, '%Y-%m-%dT%H:%M:%SZ') AS formatted_time FROM platform_txs WHERE block_number = 1234""")  # fmt: skip
def block_transactions(star: Star):
    return Q.lookup_rows(star.platform_txs(), " 1234 ")


@query("transaction_details", "Q-17 F11 X23", with_tables("platform_txs") + """
SELECT tx_id, tx_type, block_number, strftime(block_time, '%Y-%m-%dT%H:%M:%SZ') AS formatted_time, '{"subnetID":"' || subnet_id || '"}' AS tx_data FROM platform_txs WHERE tx_id = 'tx1235'""")  # fmt: skip
def transaction_details(star: Star):
    return Q.lookup_rows(star.platform_txs(), "tx1235")
