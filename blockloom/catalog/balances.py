"""Token balances and the reports over them."""

from __future__ import annotations

from pyspark.sql import functions as F

from blockloom.catalog import plain, query
from blockloom.functions.u256 import signed_text, u256_to_text
from blockloom.operators.filters import for_chain
from blockloom.plans import balances as B
from blockloom.plans import dashboards as Q
from blockloom.sources.star_schema import Star, with_tables

SIZE = 2000

ENTRIES = with_tables("token_logs") + f"""
, entries AS (
  SELECT chain_id, block_number, token, w2 AS wallet, amount, TRUE AS incoming FROM token_logs WHERE kind = 'A' AND whole
  UNION ALL SELECT chain_id, block_number, token, w1, amount, TRUE FROM token_logs WHERE kind = 'N' AND whole
  UNION ALL SELECT chain_id, block_number, token, w1, amount, FALSE FROM token_logs WHERE kind IN ('A', 'R') AND whole)
, changes AS (
  SELECT chain_id, wallet, token, block_number // {SIZE} * {SIZE} AS from_block, block_number // {SIZE} * {SIZE} + {SIZE - 1} AS to_block,
         coalesce(sum(amount) FILTER (WHERE incoming), 0) AS deposits, coalesce(sum(amount) FILTER (WHERE NOT incoming), 0) AS withdrawals
  FROM entries WHERE wallet <> 0 GROUP BY 1, 2, 3, 4, 5)
, balances AS (
  SELECT chain_id, wallet, token, sum(deposits) AS total_in, sum(withdrawals) AS total_out, sum(deposits) - sum(withdrawals) AS balance, max(to_block) AS last_updated_block
  FROM changes GROUP BY 1, 2, 3)
"""  # fmt: skip


def _changes(star: Star):
    return B.balance_changes_by_range(star.token_logs(), 0, SIZE)


@query("balance_entries", "B1 U2 X5 F7", ENTRIES + """
SELECT chain_id, token, wallet, incoming, count(*) AS n FROM entries WHERE wallet <> 0 GROUP BY 1, 2, 3, 4""")  # fmt: skip
def balance_entries(star: Star):
    entries = B.token_entries(star.token_logs())
    return plain(entries.groupBy("chain_id", "token", "wallet", "incoming").agg(F.count("*").alias("n")))


@query("balance_changes", "B2 A1 X5", ENTRIES + """
SELECT chain_id, wallet, token, from_block, to_block, CAST(deposits AS VARCHAR) AS deposits, CAST(withdrawals AS VARCHAR) AS withdrawals FROM changes""")  # fmt: skip
def balance_changes(star: Star):
    rows = _changes(star)
    return plain(rows.withColumns({c: u256_to_text(c) for c in ("deposits", "withdrawals")}))


@query("balance_changes_one_range", "B2 F3", ENTRIES + """
SELECT chain_id, wallet, token, 501 AS from_block, 1400 AS to_block, CAST(coalesce(sum(amount) FILTER (WHERE incoming), 0) AS VARCHAR) AS deposits,
       CAST(coalesce(sum(amount) FILTER (WHERE NOT incoming), 0) AS VARCHAR) AS withdrawals
FROM entries WHERE wallet <> 0 AND block_number BETWEEN 501 AND 1400 GROUP BY 1, 2, 3""")  # fmt: skip
def balance_changes_one_range(star: Star):
    rows = B.balance_changes(star.token_logs(), 501, 1400)
    return plain(rows.withColumns({c: u256_to_text(c) for c in ("deposits", "withdrawals")}))


@query("balance_view", "B3 V1 X5", ENTRIES + """
SELECT chain_id, wallet, token, CAST(total_in AS VARCHAR) AS total_in, CAST(total_out AS VARCHAR) AS total_out, CAST(balance AS VARCHAR) AS balance, last_updated_block FROM balances""")  # fmt: skip
def balance_view(star: Star):
    # every range once more with an older version: readers must see only the newest
    version = lambda deposits, second: F.struct(F.col(deposits).alias("deposits"), "withdrawals", F.timestamp_seconds(F.lit(second)).alias("computed_at"))
    both = F.inline(F.array(version("deposits", 2), version("withdrawals", 1)))
    view = B.balances(_changes(star).select(*B.RANGE_KEY, both))
    return plain(view.withColumns({"total_in": u256_to_text("total_in"), "total_out": u256_to_text("total_out"), "balance": signed_text("balance")}))


@query("balance_accumulated", "B4 V3", ENTRIES + """
SELECT chain_id, wallet, token, CAST(total_in AS VARCHAR) AS total_in, CAST(total_out AS VARCHAR) AS total_out, CAST(balance AS VARCHAR) AS balance, 99999999 AS last_updated_block FROM balances""")  # fmt: skip
def balance_accumulated(star: Star):
    first, second = [B.accumulated(star.token_logs().where(c), 99999999) for c in ("block_number < 700", "block_number >= 700")]
    view = B.accumulated_balances(first.unionByName(second))
    return plain(view.withColumns({"total_in": u256_to_text("total_in"), "total_out": u256_to_text("total_out"), "balance": signed_text("balance")}))


@query("balance_popular_tokens", "B5 F9 K2", ENTRIES + """
SELECT chain_id, token, count(*) AS holder_count FROM balances WHERE balance > 0 GROUP BY 1, 2 HAVING count(*) >= 20 ORDER BY 3 DESC, 1, 2 LIMIT 10""")  # fmt: skip
def balance_popular_tokens(star: Star):
    return plain(B.popular_tokens(B.balances(_changes(star)), 20, 10))


@query("balance_top_holders", "B6 K2", ENTRIES + """
SELECT chain_id, lpad(lower(to_hex(token)), 40, '0') AS token, lpad(lower(to_hex(wallet)), 40, '0') AS wallet_address, CAST(balance AS VARCHAR) AS balance, last_updated_block
FROM balances WHERE balances.balance > 0 ORDER BY balances.balance DESC, 1, 2, 3 LIMIT 25 OFFSET 10""")  # fmt: skip
def balance_top_holders(star: Star):
    return plain(B.top_holders(B.balances(_changes(star)), None, 25, 10))


@query("balance_top_holders_of_token", "B6 F4", ENTRIES + """
SELECT chain_id, lpad(lower(to_hex(token)), 40, '0') AS token, lpad(lower(to_hex(wallet)), 40, '0') AS wallet_address, CAST(balance AS VARCHAR) AS balance, last_updated_block
FROM balances WHERE balances.balance > 0 AND balances.token = 3 ORDER BY balances.balance DESC, 1, 2, 3 LIMIT 10""")  # fmt: skip
def balance_top_holders_of_token(star: Star):
    return plain(B.top_holders(B.balances(_changes(star)), f"{3:040x}", 10))


@query("balance_range_coverage", "B7", ENTRIES + """
SELECT chain_id, from_block, to_block, count(DISTINCT (wallet, token)) AS wallet_token_pairs, CAST(sum(deposits) AS VARCHAR) AS total_deposits,
       CAST(sum(withdrawals) AS VARCHAR) AS total_withdrawals, to_block - from_block + 1 AS blocks_in_range FROM changes GROUP BY 1, 2, 3""")  # fmt: skip
def balance_range_coverage(star: Star):
    rows = B.range_coverage(_changes(star))
    return plain(rows.withColumns({c: u256_to_text(c) for c in ("total_deposits", "total_withdrawals")}))


@query("balance_range_gaps", "B8 W5", """
WITH r AS (SELECT o_orderkey % 5 AS chain_id, o_orderkey // 5 AS from_block FROM orders WHERE o_orderstatus = 'F'),
     n AS (SELECT chain_id, from_block, lead(from_block) OVER (PARTITION BY chain_id ORDER BY from_block) AS next_start FROM r)
SELECT chain_id, from_block AS current_end, next_start, next_start - from_block - 1 AS gap_size FROM n WHERE next_start > from_block + 1""")  # fmt: skip
def balance_range_gaps(star: Star):
    n = F.floor(F.col("o_orderkey") / 5)
    done = star.table("orders").where("o_orderstatus = 'F'").select(F.pmod("o_orderkey", F.lit(5)).alias("chain_id"), n.alias("from_block"), n.alias("to_block"))
    return plain(B.range_gaps(done))


@query("balance_wallet_history", "B9", ENTRIES + """
SELECT chain_id, wallet, token, from_block, to_block, CAST(deposits AS VARCHAR) AS deposits, CAST(withdrawals AS VARCHAR) AS withdrawals, CAST(deposits - withdrawals AS VARCHAR) AS net_change
FROM changes""")  # fmt: skip
def balance_wallet_history(star: Star):
    rows = B.wallet_history(_changes(star))
    return plain(rows.withColumns({"deposits": u256_to_text("deposits"), "withdrawals": u256_to_text("withdrawals"), "net_change": signed_text("net_change")}))


@query("balance_negative_holders", "B10", ENTRIES + """
SELECT chain_id, token, count(DISTINCT wallet) AS negative_holders FROM balances WHERE balance < 0 GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 20""")  # fmt: skip
def balance_negative_holders(star: Star):
    return plain(B.negative_holders(B.balances(_changes(star)), 20))


@query("balance_verification", "B11 J9", ENTRIES + "SELECT count(*) AS pairs, count(*) AS matching FROM balances")
def balance_verification(star: Star):
    changes = _changes(star)
    checked = B.verify_balances(changes, B.balances(changes))
    return checked.agg(F.count("*").alias("pairs"), F.count_if("match").alias("matching"))


@query("balance_accumulator_progress", "B13", ENTRIES + """
SELECT chain_id, 99999999 AS max_block, count(DISTINCT (wallet, token)) AS unique_pairs FROM entries WHERE wallet <> 0 GROUP BY 1""")  # fmt: skip
def balance_accumulator_progress(star: Star):
    return plain(B.accumulator_progress(B.accumulated(star.token_logs(), 99999999)))


@query("token_transfers_by_week", "Q-18 A2 X18", with_tables("token_logs") + """
SELECT chain_id, strftime(date_trunc('week', block_time + INTERVAL 1 DAY) - INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS period, count(*) AS transfer_count, count(DISTINCT w1) AS unique_senders,
       round(CAST(coalesce(sum(amount) FILTER (WHERE whole), 0) AS DOUBLE) / 1e18, 2) AS total_amount
FROM token_logs WHERE kind = 'A' GROUP BY 1, 2""")  # fmt: skip
def token_transfers_by_week(star: Star):
    return plain(Q.token_transfers(star.token_logs(), None, 18, "week"))


@query("value_per_day", "Q-27 X5", with_tables("raw_txs") + """
SELECT chain_id, strftime(date_trunc('day', block_time), '%Y-%m-%d %H:%M:%S') AS day, CAST(sum(value) AS VARCHAR) AS total_value_transferred FROM raw_txs WHERE value > 0 GROUP BY 1, 2""")  # fmt: skip
def value_per_day(star: Star):
    return plain(Q.value_per_day(for_chain(star.raw_txs(), None)).withColumn("total_value_transferred", u256_to_text("total_value_transferred")))
