"""Platform-chain analyses: subnet lifecycle, validators, deposits, refunds, fees.

Every step takes DataFrames and returns one; ``run_platform_cycle`` wires them together as
one lazy graph.  ``as_of`` stands for the present, so that results can be repeated.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from blockloom.constants import FEE_PER_SECOND, GENESIS_SECONDS, PRIMARY_CHAINS, PRIMARY_SUBNET
from blockloom.functions.text import json_field, to_uint_or_zero
from blockloom.operators.joins import enrich_agg, lookup_first, missing_from, sum_in_span
from blockloom.operators.normalize import explode_validators
from blockloom.operators.versioned import latest_by_key, upsert
from blockloom.operators.windows import first_per_key, previous_event
from blockloom.session import cut_lineage
from blockloom.sources.tables import path_exists

UINT = "decimal(20,0)"
CREATORS = ("CreateChain", "AddSubnetValidator", "ConvertSubnetToL1", "TransformSubnet")
CONVERTERS = ("TransformSubnet", "ConvertSubnetToL1")
LEDGER_KEY = ["p_chain_id", "node_id", "tx_id"]
STATE_KEY = ["p_chain_id", "subnet_id", "validation_id"]


def _now(as_of) -> Column:
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")


def _epoch() -> Column:
    return F.timestamp_seconds(F.lit(0))


def dedup_txs(txs: DataFrame) -> DataFrame:
    """One row per transaction id, the latest if it was stored twice."""
    rest = [c for c in txs.columns if c not in ("p_chain_id", "tx_id")]
    newest = F.max_by(F.struct(*rest), F.col("block_time"))
    return txs.groupBy("p_chain_id", "tx_id").agg(newest.alias("r")).select("p_chain_id", "tx_id", "r.*").select(*txs.columns)


def _of_type(txs: DataFrame, *types: str) -> DataFrame:
    return txs.where(F.col("tx_type").isin(*types))


def subnet_conversions(txs: DataFrame, as_of=None) -> DataFrame:
    """The latest conversion of every subnet (l1_subnets)."""
    rows = _of_type(txs, *CONVERTERS).select(
        "p_chain_id",
        "tx_id",
        json_field("tx_data", "subnetID").alias("subnet_id"),
        F.coalesce(json_field("tx_data", "chainID"), F.lit("")).alias("chain_id"),
        F.col("block_number").alias("conversion_block"),
        F.col("block_time").alias("conversion_time"),
    )
    newest = latest_by_key(rows.where(F.coalesce("subnet_id", F.lit("")) != ""), ["p_chain_id", "subnet_id"], "conversion_block", ["tx_id"])
    return newest.drop("tx_id").withColumn("last_synced", _now(as_of))


def all_subnets(txs: DataFrame, as_of=None) -> DataFrame:
    """Every subnet: created by its first transaction, typed by its last conversion.

    One aggregation over the four creating types gives all of it; creation is always the
    minimum over the full history.
    """
    rows = _of_type(txs, *CREATORS).select(
        "p_chain_id",
        "tx_type",
        json_field("tx_data", "subnetID").alias("subnet_id"),
        F.coalesce(json_field("tx_data", "chainID"), F.lit("")).alias("chain_id"),
        "block_number",
        "block_time",
        "tx_id",
    )
    at = F.struct("block_number", "tx_id")
    conversion = F.col("tx_type").isin(*CONVERTERS)
    named_l1 = (F.col("tx_type") == "ConvertSubnetToL1") & (F.col("chain_id") != "")
    grouped = (
        rows.where(F.coalesce("subnet_id", F.lit("")) != "")
        .groupBy("p_chain_id", "subnet_id")
        .agg(
            F.min_by(F.struct("block_number", "block_time"), at).alias("first"),
            F.max_by(F.struct("tx_type", "block_number", "block_time"), F.when(conversion, at)).alias("last"),
            F.max_by("chain_id", F.when(named_l1, at)).alias("chain_id"),
        )
    )
    kind = F.when(F.col("last.tx_type") == "ConvertSubnetToL1", "l1").when(F.col("last.tx_type") == "TransformSubnet", "elastic").otherwise("regular")
    return grouped.select(
        "subnet_id",
        F.col("first.block_number").alias("created_block"),
        F.col("first.block_time").alias("created_time"),
        kind.alias("subnet_type"),
        F.coalesce("chain_id", F.lit("")).alias("chain_id"),
        F.coalesce(F.col("last.block_number"), F.lit(0)).alias("converted_block"),
        F.coalesce(F.col("last.block_time"), _epoch()).alias("converted_time"),
        "p_chain_id",
        _now(as_of).alias("last_updated"),
    )


def genesis_rows(spark: SparkSession, p_chain_id: int = 0, as_of=None) -> tuple[DataFrame, DataFrame]:
    """(subnet row of the primary network, its three chains)."""
    genesis = F.timestamp_seconds(F.lit(GENESIS_SECONDS))
    one = spark.range(1)
    zero = F.lit(0).cast("bigint")
    chain = F.lit(p_chain_id).cast("bigint")
    subnet = one.select(
        F.lit(PRIMARY_SUBNET).alias("subnet_id"), zero.alias("created_block"), genesis.alias("created_time"),
        F.lit("primary").alias("subnet_type"), F.lit("").alias("chain_id"), zero.alias("converted_block"),
        genesis.alias("converted_time"), chain.alias("p_chain_id"), _now(as_of).alias("last_updated"),
    )
    entries = F.array(*[F.struct(F.lit(c).alias("chain_id"), F.lit(n).alias("chain_name"), F.lit(v).alias("vm_id")) for c, n, v in PRIMARY_CHAINS])
    chains = one.select(F.inline(entries)).select(
        "chain_id", F.lit(PRIMARY_SUBNET).alias("subnet_id"), "chain_name", "vm_id", zero.alias("created_block"),
        genesis.alias("created_time"), chain.alias("p_chain_id"), _now(as_of).alias("last_updated"),
    )
    return subnet, chains


def subnet_chains(txs: DataFrame, as_of=None) -> DataFrame:
    """Chains named by conversions, with name and VM of the subnet's first CreateChain transaction."""
    field = lambda p: F.coalesce(json_field("tx_data", p), F.lit(""))
    converted = (
        _of_type(txs, "ConvertSubnetToL1")
        .select("p_chain_id", field("chainID").alias("chain_id"), field("subnetID").alias("subnet_id"))
        .where("chain_id <> '' and subnet_id <> ''")
        .groupBy("p_chain_id", "chain_id")
        .agg(F.min("subnet_id").alias("subnet_id"))
    )
    created = _of_type(txs, "CreateChain").select(
        "p_chain_id",
        field("subnetID").alias("subnet_id"),
        field("chainName").alias("chain_name"),
        field("vmID").alias("vm_id"),
        F.col("block_number").alias("created_block"),
        F.col("block_time").alias("created_time"),
        "tx_id",
    )
    first = first_per_key(created.where("subnet_id <> ''"), ["p_chain_id", "subnet_id"], ["created_block", "tx_id"]).drop("tx_id")
    return converted.join(first, ["p_chain_id", "subnet_id"], "left").select(
        "chain_id",
        "subnet_id",
        F.coalesce("chain_name", F.lit("")).alias("chain_name"),
        F.coalesce("vm_id", F.lit("")).alias("vm_id"),
        F.coalesce("created_block", F.lit(0)).alias("created_block"),
        F.coalesce("created_time", _epoch()).alias("created_time"),
        "p_chain_id",
        _now(as_of).alias("last_updated"),
    )


def validator_history(txs: DataFrame, registrations: DataFrame | None = None, as_of=None) -> DataFrame:
    """Every L1 validator from its creation: conversion lists and register transactions.

    ``registrations`` holds the decoded register messages by tx_id, and p_chain_id where it has several: subnet_id,
    node_id, validation_id, weight, bls_public_key, owner_addresses.
    """
    v = lambda path, kind="string": F.try_variant_get("validator", f"$.{path}", kind)
    listed = explode_validators(_of_type(txs, "ConvertSubnetToL1")).select(
        "subnet_id",
        v("nodeID").alias("node_id"),
        F.coalesce(v("validationID"), F.lit("")).alias("validation_id"),
        F.col("tx_id").alias("created_tx_id"),
        F.col("tx_type").alias("created_tx_type"),
        F.col("block_number").alias("created_block"),
        F.col("block_time").alias("created_time"),
        to_uint_or_zero(v("balance")).alias("initial_balance"),
        to_uint_or_zero(v("weight")).alias("initial_weight"),
        F.coalesce(v("signer.publicKey"), F.lit("")).alias("bls_public_key"),
        F.coalesce(v("remainingBalanceOwner.addresses[0]"), F.lit("")).alias("remaining_balance_owner"),
        "p_chain_id",
    )
    out = listed.where(F.coalesce("node_id", F.lit("")) != "")
    if registrations is not None:
        keys = [c for c in ("p_chain_id", "tx_id") if c in registrations.columns]
        registered = _of_type(txs, "RegisterL1Validator").join(registrations, keys).select(
            "subnet_id", "node_id", "validation_id", F.col("tx_id").alias("created_tx_id"), F.col("tx_type").alias("created_tx_type"),
            F.col("block_number").alias("created_block"), F.col("block_time").alias("created_time"),
            to_uint_or_zero(json_field("tx_data", "balance")).alias("initial_balance"), F.col("weight").cast(UINT).alias("initial_weight"),
            "bls_public_key", F.coalesce(F.get("owner_addresses", F.lit(0)), F.lit("")).alias("remaining_balance_owner"), "p_chain_id",
        )
        out = out.unionByName(registered.where(F.coalesce("node_id", F.lit("")) != ""))
    return out.withColumn("last_updated", _now(as_of))


def legacy_subnets(subnets: DataFrame) -> DataFrame:
    """Regular and elastic subnets in creation order."""
    return (
        subnets.where(F.col("subnet_type").isin("regular", "elastic"))
        .groupBy("p_chain_id", "subnet_id")
        .agg(F.min("created_block").alias("created_block"))
        .orderBy("created_block", "subnet_id")
    )


def monitored_subnets(l1_subnets: DataFrame) -> DataFrame:
    return l1_subnets.select("p_chain_id", "subnet_id").distinct()


def mark_inactive(state: DataFrame, snapshot: DataFrame, as_of=None) -> DataFrame:
    """New versions for active validators that a subnet's snapshot no longer lists.

    Subnets the snapshot has no row of are left alone: an empty answer deactivates nobody.
    """
    current = latest_by_key(state, STATE_KEY, "last_updated").where("active")
    answered = snapshot.select("p_chain_id", "subnet_id").distinct()
    gone = missing_from(current, snapshot, STATE_KEY).join(answered, ["p_chain_id", "subnet_id"], "left_semi")
    return gone.withColumn("active", F.lit(False)).withColumn("last_updated", _now(as_of)).select(*state.columns)


def balance_ledger(txs: DataFrame, state: DataFrame, history: DataFrame) -> DataFrame:
    """All deposits: top-ups of known validators and positive initial balances."""
    validators = (
        state.groupBy("p_chain_id", "validation_id")
        .agg(F.min_by(F.struct("subnet_id", "node_id"), F.struct("subnet_id", "node_id")).alias("v"))
        .select("p_chain_id", "validation_id", "v.subnet_id", "v.node_id")
    )
    topups = _of_type(txs, "IncreaseL1ValidatorBalance").select(
        json_field("tx_data", "validationID").alias("validation_id"),
        "tx_id",
        "tx_type",
        "block_number",
        "block_time",
        to_uint_or_zero(json_field("tx_data", "balance")).alias("amount"),
        "p_chain_id",
    )
    initial = history.where(F.col("initial_balance") > 0).select(
        "validation_id", F.col("created_tx_id").alias("tx_id"), F.col("created_tx_type").alias("tx_type"),
        F.col("created_block").alias("block_number"), F.col("created_time").alias("block_time"),
        F.col("initial_balance").alias("amount"), "subnet_id", "node_id", "p_chain_id",
    )
    return topups.join(validators, ["p_chain_id", "validation_id"]).unionByName(initial)


def refunds(txs: DataFrame, ledger: DataFrame, history: DataFrame, state: DataFrame, rate: int = FEE_PER_SECOND) -> DataFrame:
    """Refund of every disable transaction: deposits of its active span less the fees of that span, not below 0.

    The span starts at the validator's previous disable (deposits at that moment excluded) or at
    its creation (included).  Rows without a subnet or with a refund of 0 are left out.
    """
    disables = _of_type(txs, "DisableL1Validator").select(
        "tx_id", json_field("tx_data", "validationID").alias("validation_id"), "block_number", "block_time", "p_chain_id"
    )
    spans = previous_event(disables, ["p_chain_id", "validation_id"], "block_time", "previous", width=86400)
    keys = ["p_chain_id", "validation_id"]
    facts = history.groupBy(*keys).agg(
        F.min_by(F.struct("subnet_id", "remaining_balance_owner", "created_time"), F.struct("created_block", "created_tx_id")).alias("h")
    )
    known = state.groupBy(*keys).agg(F.min("subnet_id").alias("state_subnet"), F.min("start_time").alias("state_start"))
    spans = (
        spans.join(facts, keys, "left")
        .join(known, keys, "left")
        .select(
            "tx_id", "validation_id", "p_chain_id", "block_number", "block_time",
            F.coalesce("h.subnet_id", "state_subnet").alias("subnet_id"),
            F.coalesce("h.remaining_balance_owner", F.lit("")).alias("refund_address"),
            F.coalesce("previous", "h.created_time", "state_start").alias("start_time"),
            F.col("block_time").alias("end_time"),
            F.col("previous").isNotNull().alias("start_exclusive"),
        )
        .where("subnet_id is not null and start_time is not null")
    )
    summed = sum_in_span(spans, ledger, keys, ["p_chain_id", "tx_id"], out="deposits", width=86400)
    seconds = F.greatest(F.unix_timestamp("end_time") - F.unix_timestamp("start_time"), F.lit(0))
    refund = F.greatest(F.col("deposits") - (seconds * rate).cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)"))
    return (
        summed.withColumn("refund_amount", refund.cast(UINT))
        .where("refund_amount > 0")
        .select("tx_id", "validation_id", "subnet_id", "refund_amount", "refund_address", "block_number", "block_time", "p_chain_id")
    )


def _fees(deposited: Column, refunded: Column, balance: Column) -> Column:
    wide = lambda c: c.cast("decimal(38,0)")
    return F.greatest(wide(deposited) - wide(refunded) - wide(balance), F.lit(0).cast("decimal(38,0)"))


def subnet_fee_stats(ledger: DataFrame, refund_rows: DataFrame, state: DataFrame, subnets: DataFrame, as_of=None) -> DataFrame:
    """Deposits, refunds, balance and fees per L1 subnet."""
    initial = F.col("tx_type").isin("ConvertSubnetToL1", "RegisterL1Validator")
    wide = "decimal(38,0)"
    keys = ["p_chain_id", "subnet_id"]
    deposits = ledger.groupBy(*keys).agg(
        F.sum(F.when(initial, F.col("amount"))).cast(wide).alias("initial_deposits"),
        F.sum(F.when(F.col("tx_type") == "IncreaseL1ValidatorBalance", F.col("amount"))).cast(wide).alias("top_up_deposits"),
        F.sum("amount").cast(wide).alias("total_deposited"),
        F.count_if(initial).alias("validator_count"),
        F.count("*").alias("deposit_tx_count"),
    )
    refunded = refund_rows.groupBy(*keys).agg(F.sum("refund_amount").cast(wide).alias("total_refunded"))
    held = state.groupBy(*keys).agg(F.sum("balance").cast(wide).alias("current_balance"))
    amounts = ["initial_deposits", "top_up_deposits", "total_deposited", "validator_count", "deposit_tx_count", "total_refunded", "current_balance"]
    l1 = subnets.where("subnet_type = 'l1'").select(*keys).distinct()
    stats = enrich_agg(l1, [deposits, refunded, held], keys, {c: 0 for c in amounts})
    return stats.select(
        *keys,
        "total_deposited",
        "initial_deposits",
        "top_up_deposits",
        "total_refunded",
        "current_balance",
        _fees(F.col("total_deposited"), F.col("total_refunded"), F.col("current_balance")).alias("total_fees_paid"),
        "deposit_tx_count",
        "validator_count",
        _now(as_of).alias("last_updated"),
    )


def validator_fee_stats(state: DataFrame, history: DataFrame, ledger: DataFrame, refund_rows: DataFrame, as_of=None) -> DataFrame:
    """State rows with initial deposit, top-ups, refund and fees; the primary network has none.

    Everything is summed per validation id first, so repeated registrations or disables cannot multiply rows.
    """
    keys = ["p_chain_id", "validation_id"]
    first = history.groupBy(*keys).agg(F.sum("initial_balance").cast("decimal(38,0)").alias("initial_deposit"))
    topups = (
        ledger.where("tx_type = 'IncreaseL1ValidatorBalance'").groupBy(*keys).agg(F.sum("amount").cast("decimal(38,0)").alias("total_topups"))
    )
    back = refund_rows.groupBy(*keys).agg(F.sum("refund_amount").cast("decimal(38,0)").alias("refund_amount"))
    computed = ["initial_deposit", "total_topups", "refund_amount"]
    rows = state.where(F.col("subnet_id") != PRIMARY_SUBNET).drop(*computed, "fees_paid", "last_updated")
    out = enrich_agg(rows, [first, topups, back], keys, {c: 0 for c in computed})
    fees = _fees(F.col("initial_deposit") + F.col("total_topups"), F.col("refund_amount"), F.col("balance"))
    return out.withColumn("fees_paid", fees).withColumn("last_updated", _now(as_of))


# Transaction types the derived tables are made from; all others are left in the table.
USED_TYPES = (*CREATORS, "RegisterL1Validator", "IncreaseL1ValidatorBalance", "DisableL1Validator")


def run_platform_cycle(
    txs: DataFrame, snapshot: DataFrame, registrations: DataFrame | None = None, state: DataFrame | None = None, as_of=None, p_chain_id: int = 0,
    materialize=cut_lineage,
) -> dict[str, DataFrame]:
    """All derived platform tables from transactions and the current validator snapshot (as state rows).

    ``state`` holds earlier state versions; validators missing from the snapshot become inactive.
    The transactions are scanned once: the few types that matter, and the tables several later
    steps read, are written to shared storage by ``materialize``, as the steps of a sync cycle are.
    """
    spark = txs.sparkSession
    txs = materialize(_of_type(txs, *USED_TYPES))
    snapshot = materialize(snapshot)
    primary, primary_chains = genesis_rows(spark, p_chain_id, as_of)
    subnets = materialize(all_subnets(txs, as_of)).unionByName(primary)
    chains = subnet_chains(txs, as_of).unionByName(primary_chains)
    history = materialize(validator_history(txs, registrations, as_of))
    versions = snapshot if state is None else state.unionByName(snapshot).unionByName(mark_inactive(state, snapshot, as_of))
    current = latest_by_key(versions, STATE_KEY, "last_updated")
    current = current if state is None else materialize(current)
    ledger = materialize(balance_ledger(txs, current, history))
    returned = materialize(refunds(txs, ledger, history, current))
    return {
        "subnets": subnets,
        "subnet_chains": chains,
        "l1_subnets": subnet_conversions(txs, as_of),
        "l1_validator_history": history,
        "l1_validator_balance_txs": ledger,
        "l1_validator_refunds": returned,
        "l1_fee_stats": subnet_fee_stats(ledger, returned, current, subnets, as_of),
        "l1_validator_state": validator_fee_stats(current, history, ledger, returned, as_of),
        "primary_validators": current.where(F.col("subnet_id") == PRIMARY_SUBNET),
    }


# --- the stored cycle -----------------------------------------------------------------------------

#: Stored tables and what names a row of each.
PLATFORM_TABLES = {
    "subnets": ["p_chain_id", "subnet_id"],
    "subnet_chains": ["p_chain_id", "chain_id"],
    "l1_subnets": ["p_chain_id", "subnet_id"],
    "l1_validator_history": ["p_chain_id", "created_tx_id", "node_id", "validation_id"],
    "l1_validator_balance_txs": [*LEDGER_KEY, "validation_id"],
    "l1_validator_refunds": ["p_chain_id", "tx_id"],
    "l1_fee_stats": ["p_chain_id", "subnet_id"],
    "l1_validator_state": STATE_KEY,
}
_VERSION = "stored_at"
_NOT_COMPARED = ("last_updated", "last_synced", _VERSION)


def platform_versions(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """Every stored version of a platform table's rows, or None before the first cycle."""
    path = f"{root}/platform/{name}"
    return spark.read.parquet(path) if path_exists(spark, path) else None


def platform_table(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """The newest version of each row of a platform table."""
    stored = platform_versions(spark, root, name)
    return None if stored is None else latest_by_key(stored, PLATFORM_TABLES[name], _VERSION).drop(_VERSION)


def changed_rows(rows: DataFrame, current: DataFrame | None, keys: list[str]) -> DataFrame:
    """Rows that ``current`` lacks or holds with other values; when they were last looked at does not count."""
    if current is None:
        return rows
    facts = [c for c in rows.columns if c not in keys and c not in _NOT_COMPARED]
    same_type = [F.col(c).cast(rows.schema[c].dataType).alias(c) for c in facts]
    held = current.select(*[F.col(k).alias(f"_{k}") for k in keys], F.struct(*same_type).alias("_held"))
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return rows.join(held, match, "left").where(~F.struct(*facts).eqNullSafe(F.col("_held"))).select(*rows.columns)


def store_platform_cycle(
    spark: SparkSession, root: str, txs: DataFrame, snapshot: DataFrame, registrations: DataFrame | None = None, as_of=None, p_chain_id: int = 0
) -> dict[str, DataFrame]:
    """One sync cycle over what earlier cycles stored: derive all tables, append the rows that differ from the stored ones.

    Validators that the snapshot no longer lists get an inactive version, those that come back an active one.  A cycle that
    broke half-way can be repeated: what it has stored does not differ any more.  Returns the tables as they are then.
    """
    state = platform_table(spark, root, "l1_validator_state")
    done = run_platform_cycle(txs, snapshot, registrations, state, as_of, p_chain_id)
    primary = done.pop("primary_validators")
    done["l1_validator_state"] = done["l1_validator_state"].unionByName(primary.select(*done["l1_validator_state"].columns))
    for name, keys in PLATFORM_TABLES.items():
        new = changed_rows(done[name], platform_table(spark, root, name), keys)
        upsert(new.withColumn(_VERSION, _now(as_of)), f"{root}/platform/{name}")
    return {name: platform_table(spark, root, name) for name in PLATFORM_TABLES}


def start_platform_cycles(
    ticks: DataFrame, root: str, checkpoint: str, inputs: Callable[[], tuple[DataFrame, DataFrame, DataFrame | None]], p_chain_id: int = 0, every: str = "5 minutes", once: bool = False
) -> StreamingQuery:
    """Repeat the cycle whenever ``ticks``, a stream of snapshot files or the like, brings something, at most once in ``every``.

    ``inputs`` gives the transactions, the current snapshot (as state rows) and the registrations at that moment.
    """
    spark = ticks.sparkSession

    def handle(batch: DataFrame, batch_id: int) -> None:
        store_platform_cycle(spark, root, *inputs(), p_chain_id=p_chain_id)

    writer = ticks.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()


def subnet_of_validation(rows: DataFrame, history: DataFrame, state: DataFrame) -> DataFrame:
    """Subnet id of a validation id, from history first, then from state."""
    keys = [c for c in ("p_chain_id", "validation_id") if c in rows.columns]
    return lookup_first(rows, [history, state], keys, "subnet_id")

