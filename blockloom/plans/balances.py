"""Token balances from transfer logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockloom.constants import BLOCKS_PER_BATCH, DEPOSIT, TRANSFER, WITHDRAWAL
from blockloom.functions.hexes import byte_length, non_zero, to_hex, topic_address
from blockloom.functions.u256 import u256_diff, u256_lit, u256_sum, u256_sums_by, u256_to_text
from blockloom.operators.filters import bytes_in, in_block_range
from blockloom.operators.joins import compare
from blockloom.operators.sets import union_endpoints
from blockloom.operators.sorting import top_k
from blockloom.operators.versioned import latest_by_key
from blockloom.operators.windows import next_value

PAIR = ["chain_id", "wallet", "token"]
RANGE_KEY = ["chain_id", "token", "wallet", "from_block", "to_block"]


def token_entries(logs: DataFrame) -> DataFrame:
    """Signed entries of transfer, deposit and withdrawal logs: (chain_id, block_number, token, wallet, amount, incoming).

    A transfer gives one entry to its recipient and one to its sender.  The four cases are
    branches of one array per log, so the table is scanned once.
    """
    entry = lambda topic, incoming, when: F.when(
        when & F.col(topic).isNotNull(), F.struct(topic_address(topic).alias("wallet"), F.lit(incoming).alias("incoming"))
    )
    transfer, deposit, withdrawal = [bytes_in("topic0", [s]) for s in (TRANSFER, DEPOSIT, WITHDRAWAL)]
    entries = F.array_compact(
        F.array(entry("topic2", True, transfer), entry("topic1", True, deposit), entry("topic1", False, transfer | withdrawal))
    )
    return (
        logs.where(bytes_in("topic0", [TRANSFER, DEPOSIT, WITHDRAWAL]) & (byte_length("data") == 32))
        .select("chain_id", "block_number", F.col("address").alias("token"), F.col("data").alias("amount"), F.inline(entries))
        .where(non_zero("wallet"))
        .select("chain_id", "block_number", "token", "wallet", "amount", "incoming")
    )


def _changing(logs: DataFrame) -> DataFrame:
    """Entries that move something: a pair has a change exactly if it has one of these."""
    return token_entries(logs).where(F.col("amount") != u256_lit(0))


def _in_out() -> dict:
    return {"deposits": ("amount", F.col("incoming")), "withdrawals": ("amount", ~F.col("incoming"))}


def balance_changes(logs: DataFrame, from_block: int, to_block: int) -> DataFrame:
    """Deposits and withdrawals per wallet and token in one inclusive block range; pairs without change are left out."""
    entries = _changing(in_block_range(logs, from_block, to_block))
    return (
        u256_sums_by(entries, PAIR, _in_out())
        .select(*PAIR, F.lit(from_block).cast("bigint").alias("from_block"), F.lit(to_block).cast("bigint").alias("to_block"), "deposits", "withdrawals")
    )


def balance_changes_by_range(logs: DataFrame, start: int = 0, size: int = BLOCKS_PER_BATCH) -> DataFrame:
    """The same for every range of ``size`` blocks at once: the backfill of a whole history in one job."""
    offset = F.col("block_number").cast("bigint") - start
    low = offset - F.pmod(offset, F.lit(size).cast("bigint")) + start
    return (
        u256_sums_by(_changing(logs), [*PAIR, low.alias("from_block")], _in_out())
        .select(*PAIR, "from_block", (F.col("from_block") + size - 1).alias("to_block"), "deposits", "withdrawals")
    )


def current_changes(changes: DataFrame) -> DataFrame:
    """Newest version per range row, if the table is versioned.

    A range is named by its first block: a last range that was not full grows when it is run again.
    """
    # ranges first: the rows are sorted by these keys, and a number of many values is compared without reading bytes
    keys = ["from_block", *[c for c in RANGE_KEY if c not in ("from_block", "to_block")]]
    return latest_by_key(changes, keys, "computed_at", ["to_block"]) if "computed_at" in changes.columns else changes


_TOTALS = {"total_in": ("deposits", None), "total_out": ("withdrawals", None)}


def balances(changes: DataFrame) -> DataFrame:
    """Balance view: total_in, total_out, signed balance, last block."""
    return _balance(u256_sums_by(current_changes(changes), PAIR, _TOTALS, [F.max("to_block").alias("last_updated_block")]))


def _balance(sums: DataFrame) -> DataFrame:
    return sums.withColumn("balance", u256_diff("total_in", "total_out"))


def accumulated(logs: DataFrame, to_block: int) -> DataFrame:
    """Rows of the accumulating variant: one batch's sums per pair, added to earlier batches at read time."""
    sums = u256_sums_by(_changing(in_block_range(logs, None, to_block)), PAIR, _in_out())
    return sums.withColumn("last_block", F.lit(to_block).cast("bigint"))


def accumulated_balances(rows: DataFrame) -> DataFrame:
    return _balance(u256_sums_by(rows, PAIR, _TOTALS, [F.max("last_block").alias("last_updated_block")]))


def positive() -> Column:
    """Balance above zero, judged by the totals: a filter on the difference would compute it twice."""
    return F.col("total_in") > F.col("total_out")


def popular_tokens(bal: DataFrame, min_holders: int = 20, k: int = 1) -> DataFrame:
    """Tokens with the most holders of a positive balance, at least ``min_holders``."""
    holders = bal.where(positive()).groupBy("chain_id", "token").agg(F.count("*").alias("holder_count"))
    return top_k(holders.where(F.col("holder_count") >= min_holders), "holder_count", k, ["chain_id", "token"])


def top_holders(bal: DataFrame, token: str | None, k: int = 10, offset: int = 0) -> DataFrame:
    """Largest positive balances of a token (of all tokens if None)."""
    rows = bal.where(positive())
    if token is not None:
        rows = rows.where(bytes_in("token", [token]))
    return (
        rows.orderBy(F.desc("balance.magnitude"), "chain_id", "token", "wallet")
        .offset(offset)
        .limit(k)
        .select("chain_id", to_hex("token").alias("token"), to_hex("wallet").alias("wallet_address"), u256_to_text("balance.magnitude").alias("balance"), "last_updated_block")
    )


def range_coverage(changes: DataFrame) -> DataFrame:
    """Processed ranges: size, wallet-token pairs, totals."""
    current = current_changes(changes)
    return (
        current.groupBy("chain_id", "from_block", "to_block")
        .agg(
            # one row per pair and range, so a plain count is the distinct count
            F.count("*").alias("wallet_token_pairs"),
            u256_sum("deposits").alias("total_deposits"),
            u256_sum("withdrawals").alias("total_withdrawals"),
        )
        .withColumn("blocks_in_range", F.col("to_block") - F.col("from_block") + 1)
    )


def range_gaps(changes: DataFrame) -> DataFrame:
    """Blocks between one processed range and the next that no range covers."""
    done = changes.select("chain_id", "from_block", "to_block").distinct()
    ordered = next_value(done, "from_block", "from_block", ["chain_id"], "next_start")
    return ordered.where(F.col("next_start") > F.col("to_block") + 1).select(
        "chain_id", F.col("to_block").alias("current_end"), "next_start", (F.col("next_start") - F.col("to_block") - 1).alias("gap_size")
    )


def wallet_history(changes: DataFrame, wallet=None, token=None) -> DataFrame:
    """Range rows of one wallet and token with their net change."""
    rows = current_changes(changes)
    if wallet is not None:
        rows = rows.where(bytes_in("wallet", [wallet]))
    if token is not None:
        rows = rows.where(bytes_in("token", [token]))
    return rows.withColumn("net_change", u256_diff("deposits", "withdrawals"))


def negative_holders(bal: DataFrame, k: int = 20) -> DataFrame:
    """Tokens ranked by wallets with a negative balance."""
    counted = bal.where(F.col("total_in") < F.col("total_out")).groupBy("chain_id", "token").agg(F.count("*").alias("negative_holders"))
    return top_k(counted, "negative_holders", k, ["chain_id", "token"])


def verify_balances(changes: DataFrame, view: DataFrame) -> DataFrame:
    """Recomputed totals next to those of the balance view, per pair, with a match flag."""
    manual = u256_sums_by(current_changes(changes), PAIR, _TOTALS)
    return compare(manual, view.select(*PAIR, "total_in", "total_out"), PAIR, ["total_in", "total_out"])


def address_on_chain(traces: DataFrame) -> DataFrame:
    """Every (address, chain) pair that appears on either end of a call."""
    ends = union_endpoints(traces.select("chain_id", "from", "to"), "from", "to")
    return ends.where(non_zero("address")).distinct().select("address", "chain_id")


def chains_of(pairs: DataFrame, address: str) -> DataFrame:
    return pairs.where(bytes_in("address", [address])).select("chain_id").distinct()


def accumulator_progress(rows: DataFrame) -> DataFrame:
    """Highest block and pairs per chain of the accumulating variant, and the last update if rows carry ``computed_at``."""
    updated = [F.max("computed_at").alias("last_update")] if "computed_at" in rows.columns else []
    pairs = rows.groupBy(*PAIR).agg(F.max("last_block").alias("last_block"), *updated)
    newest = [F.max("last_update").alias("last_update")] if updated else []
    return pairs.groupBy("chain_id").agg(F.max("last_block").alias("max_block"), F.count("*").alias("unique_pairs"), *newest)
