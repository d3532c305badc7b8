"""The named queries behind the dashboard pages and the example queries.

Chain id, subnet id and the like may be None where a query makes sense over all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blockloom.constants import CREATE_CALLS, MESSAGE_RECEIVED, MESSAGE_SENT, TRANSFER
from blockloom.functions.hexes import byte_length, to_hex
from blockloom.functions.periods import epoch_seconds, period_start
from blockloom.functions.text import DATE_PATTERN, ISO_PATTERN, days_between, fmt_time, json_field
from blockloom.functions.u256 import u256_lit, u256_sum, u256_to_double, u256_to_text
from blockloom.operators.aggregates import scalars
from blockloom.operators.filters import bytes_in, find_one, for_chain, in_time_range, since
from blockloom.operators.joins import active_by_type, merge_full, not_in
from blockloom.operators.sorting import numeric_text, rank_order, top_k
from blockloom.operators.versioned import latest_by_key
from blockloom.operators.windows import running_sum

# --- sync status -----------------------------------------------------------------------


def sync_status(chain_status: DataFrame, watermarks: DataFrame) -> DataFrame:
    """Chains with blocks behind and percent synced."""
    joined = chain_status.join(watermarks.withColumnRenamed("block_number", "watermark_block"), "chain_id", "left")
    percent = F.when(F.col("watermark_block").isNotNull(), F.col("watermark_block") / F.col("last_block_on_chain") * 100)
    return joined.select(
        "chain_id",
        "name",
        epoch_seconds("last_updated").alias("last_updated"),
        "last_block_on_chain",
        "watermark_block",
        F.coalesce(percent, F.lit(0.0)).alias("sync_percentage"),
        (F.col("last_block_on_chain") - F.col("watermark_block")).alias("blocks_behind"),
    ).orderBy("chain_id")


def health(status: DataFrame, as_of) -> DataFrame:
    """Traffic-light colours for lag and age."""
    behind, age = F.col("blocks_behind"), _now(as_of).cast("bigint") - F.col("last_updated")
    return status.withColumn(
        "lag_health", F.when(behind.isNull(), "gray").when(behind < 10, "green").when(behind < 1000, "yellow").otherwise("red")
    ).withColumn("age_health", F.when(age < 60, "green").when(age < 3600, "yellow").otherwise("red"))


def _now(as_of) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")


# --- platform overview -------------------------------------------------------------------


def _platform(df: DataFrame, p_chain_id: int | None) -> DataFrame:
    """Rows of one platform chain, or all of them."""
    return df if p_chain_id is None else df.where(F.col("p_chain_id") == p_chain_id)


def platform_stats(state: DataFrame, subnets: DataFrame, txs: DataFrame, fees: DataFrame, as_of, p_chain_id: int | None = None) -> DataFrame:
    """Six global numbers in one row."""
    state, subnets, txs, fees = (_platform(df, p_chain_id) for df in (state, subnets, txs, fees))
    recent = since(txs, "block_time", "7 DAY", as_of)
    return scalars(
        active_l1_subnets=_wide(active_by_type(state, subnets, ["l1"])),
        active_legacy_subnets=_wide(active_by_type(state, subnets, ["regular"])),
        active_chains=_wide(active_by_type(state, subnets, ["l1", "regular", "primary"])),
        active_validators=_wide(active_by_type(state, subnets, ["primary", "l1"], "node_id")),
        recent_transactions=_wide(recent.agg(F.count("*").alias("n"))),
        total_l1_fees_paid=_wide(fees.agg(F.sum("total_fees_paid").alias("n"))),
    )


def _wide(df: DataFrame) -> DataFrame:
    return df.select(F.col(df.columns[0]).cast("decimal(38,0)").alias("n"))


def conversion_timeline(subnets: DataFrame) -> DataFrame:
    """L1 conversions up to the end of each month that has any."""
    months = (
        subnets.where((F.col("subnet_type") == "l1") & (epoch_seconds("converted_time") > 1))
        .groupBy(fmt_time(period_start("converted_time", "month"), DATE_PATTERN).alias("period"))
        .agg(F.count("*").alias("n"))
    )
    # one row per month
    return running_sum(months, "n", "period", [], "value").select("period", "value").orderBy("period")


def tx_type_activity(txs: DataFrame, as_of, days: int = 30, k: int = 10, p_chain_id: int | None = None) -> DataFrame:
    counted = since(_platform(txs, p_chain_id), "block_time", f"{days} DAY", as_of).groupBy("tx_type").agg(F.count("*").alias("count"))
    return top_k(counted, "count", k, ["tx_type"])


# Order of subnet types on the overview page.
TYPE_ORDER = ["primary", "l1", "elastic", "regular"]


def subnet_table(subnets: DataFrame, registry: DataFrame, state: DataFrame, fees: DataFrame) -> DataFrame:
    """All subnets with name, active validators and fees, L1s with most validators first."""
    active = state.where("active").groupBy("subnet_id").agg(F.count("*").alias("validator_count"))
    named = registry.select("subnet_id", F.nullif("name", F.lit("")).alias("name"), F.nullif("logo_url", F.lit("")).alias("logo_url"))
    paid = fees.groupBy("subnet_id").agg(F.sum("total_fees_paid").alias("total_fees_paid"))
    rows = subnets.join(named, "subnet_id", "left").join(active, "subnet_id", "left").join(paid, "subnet_id", "left")
    out = rows.select(
        "subnet_id",
        "subnet_type",
        "chain_id",
        "created_block",
        fmt_time("created_time").alias("created_time"),
        F.col("converted_block").alias("conversion_block"),
        fmt_time("converted_time").alias("conversion_time"),
        F.coalesce("validator_count", F.lit(0)).alias("validator_count"),
        "name",
        "logo_url",
        F.coalesce("total_fees_paid", F.lit(0)).alias("total_fees_paid"),
    )
    return rank_order(out, "subnet_type", TYPE_ORDER, [F.desc("validator_count"), F.desc("created_time"), F.asc("subnet_id")])


def recent_blocks(txs: DataFrame, as_of, k: int = 8, p_chain_id: int | None = None) -> DataFrame:
    recent = since(_platform(txs, p_chain_id), "block_time", "1 DAY", as_of)
    blocks = recent.groupBy("block_number").agg(
        epoch_seconds(F.max("block_time")).alias("timestamp"),
        F.count("*").alias("tx_count"),
        F.substring(F.min("tx_id"), 1, 12).alias("block_hash"),
    )
    return top_k(blocks, "block_number", k)


def recent_txs(txs: DataFrame, as_of, k: int = 8, p_chain_id: int | None = None) -> DataFrame:
    rows = top_k(since(_platform(txs, p_chain_id), "block_time", "1 DAY", as_of).select("tx_id", "tx_type", "block_time", "block_number"), "block_time", k, ["tx_id"])
    return rows.select("tx_id", "tx_type", fmt_time("block_time", ISO_PATTERN).alias("formatted_time"), "block_number")


def lookup(text: str) -> tuple[str, str | int]:
    """Route of a search text: digits are a block number, anything else a transaction id."""
    text = text.strip()
    return ("block", int(text)) if text.isdigit() else ("tx", text)


def lookup_rows(txs: DataFrame, text: str) -> DataFrame:
    kind, value = lookup(text)
    return block_txs(txs, value) if kind == "block" else tx_details(txs, value)


# --- subnet and validator pages -----------------------------------------------------------

# Fixed value: shorter node ids are malformed.
MIN_NODE_ID = 30


def _of_subnet(df: DataFrame, subnet_id: str | None) -> DataFrame:
    return df if subnet_id is None else df.where(F.col("subnet_id") == subnet_id)


def subnet_details(subnets: DataFrame, registry: DataFrame, state: DataFrame, history: DataFrame, subnet_id: str | None = None) -> DataFrame:
    """Subnet page header; one row per subnet if no id is given."""
    ever = (
        _of_subnet(history, subnet_id).where(byte_length("node_id") > MIN_NODE_ID).groupBy("subnet_id").agg(F.count_distinct("node_id").alias("validator_count"))
    )
    weight = (
        _of_subnet(state, subnet_id).where((byte_length("node_id") > MIN_NODE_ID) & F.col("active")).groupBy("subnet_id").agg(F.sum("weight").alias("total_weight"))
    )
    text = lambda c: F.nullif(c, F.lit("")).alias(c)
    named = registry.select("subnet_id", text("name"), text("description"), text("logo_url"), text("website_url"))
    rows = _of_subnet(subnets, subnet_id).join(ever, "subnet_id", "left").join(weight, "subnet_id", "left").join(named, "subnet_id", "left")
    out = rows.select(
        "subnet_id",
        "subnet_type",
        "chain_id",
        F.col("converted_block").alias("conversion_block"),
        fmt_time("converted_time").alias("conversion_time"),
        F.coalesce("validator_count", F.lit(0)).alias("validator_count"),
        F.coalesce("total_weight", F.lit(0)).cast("string").alias("total_weight"),
        "name",
        "description",
        "logo_url",
        "website_url",
    )
    return out if subnet_id is None else out.limit(1)


def stake_validators(state: DataFrame, subnet_id: str | None = None) -> DataFrame:
    """Validators of primary and regular subnets; the stake is shown as balance."""
    return (
        _of_subnet(state, subnet_id)
        .orderBy(F.desc("weight"), "validation_id")
        .select(
            "subnet_id", "validation_id", "node_id", F.col("weight").cast("string").alias("weight"), F.col("weight").cast("string").alias("balance"),
            fmt_time("start_time").alias("start_time"), fmt_time("end_time").alias("end_time"), "uptime_percentage", "active",
            fmt_time("last_updated").alias("last_updated"),
        )
    )


def _burn(initial: Column, balance: Column, start, as_of) -> tuple[Column, Column, Column]:
    """(fees paid, daily burn, days until empty) from the initial and the current balance."""
    zero = F.lit(0).cast("decimal(38,0)")
    fees = F.greatest(initial.cast("decimal(38,0)") - balance.cast("decimal(38,0)"), zero)
    days = days_between(start, _now(as_of))
    burning = (days > 0) & (fees > 0)
    daily = F.when(burning, fees.cast("double") / days).otherwise(F.lit(0.0))
    left = F.when(burning, balance.cast("double") / F.nullif(daily, F.lit(0.0))).otherwise(F.lit(0.0))
    return fees, daily, left


def l1_validators(state: DataFrame, history: DataFrame, subnet_id: str | None, as_of) -> DataFrame:
    """Validators of L1 subnets: current ones with their history, then those known from history only.

    A node that registered more than once in a subnet shows its newest registration, so rows do not multiply.
    """
    keys = ["subnet_id", "node_id"]
    state = _of_subnet(state, subnet_id).where(byte_length("node_id") > 0)
    past = _of_subnet(history, subnet_id).where(byte_length("node_id") > 0).drop("validation_id", "p_chain_id", "last_updated")
    past = latest_by_key(past, keys, "created_block", ["created_tx_id"])
    initial = F.coalesce("initial_balance", F.lit(0).cast("decimal(20,0)"))
    fees, daily, left = _burn(initial, F.col("balance"), "start_time", as_of)
    text = lambda c: c.cast("string")
    created = [
        "created_tx_type", "created_tx_id", "created_block", fmt_time("created_time").alias("created_time"),
        text(F.col("initial_balance")).alias("initial_balance"), text(F.col("initial_weight")).alias("initial_weight"), "bls_public_key",
    ]
    current = state.join(past, keys, "left").select(
        "subnet_id", "validation_id", "node_id", text(F.col("weight")).alias("weight"), text(F.col("balance")).alias("balance"),
        fmt_time("start_time").alias("start_time"), fmt_time("end_time").alias("end_time"), "uptime_percentage", "active",
        fmt_time("last_updated").alias("last_updated"), *created, text(initial).alias("initial_deposit"), F.lit("0").alias("total_topups"),
        text(F.col("balance")).alias("refund_amount"), text(fees).alias("fees_paid"), daily.alias("daily_burn_rate"), left.alias("days_until_empty"),
    )
    gone = past.join(state.select(*keys), keys, "left_anti") if subnet_id is None else not_in(past, state, "node_id")
    only_past = gone.select(
        "subnet_id", F.lit("").alias("validation_id"), "node_id", text(F.col("initial_weight")).alias("weight"), F.lit("0").alias("balance"),
        fmt_time("created_time").alias("start_time"), F.lit("1970-01-01 00:00:00").alias("end_time"), F.lit(0.0).alias("uptime_percentage"),
        F.lit(False).alias("active"), fmt_time("created_time").alias("last_updated"), *created,
        text(F.col("initial_balance")).alias("initial_deposit"), F.lit("0").alias("total_topups"), F.lit("0").alias("refund_amount"),
        text(F.col("initial_balance")).alias("fees_paid"), F.lit(0.0).alias("daily_burn_rate"), F.lit(0.0).alias("days_until_empty"),
    )
    both = current.unionByName(only_past)
    return both.orderBy(F.desc("active"), numeric_text("weight").desc(), "node_id")


def validator_details(state: DataFrame, history: DataFrame, as_of, subnet_id: str | None = None, node_id: str | None = None) -> DataFrame:
    """One validator from state, history or both; every validator if no ids are given."""
    pick = lambda df: _of_subnet(df, subnet_id) if node_id is None else _of_subnet(df, subnet_id).where(F.col("node_id") == node_id)
    keys = ["subnet_id", "node_id"]
    now = pick(state).groupBy(*keys).agg(
        F.max_by(F.struct("validation_id", "weight", "balance", "start_time", "end_time", "uptime_percentage", "active", "last_updated"), F.struct("last_updated", "validation_id")).alias("s")
    )
    past = pick(history).groupBy(*keys).agg(
        F.min_by(F.struct("validation_id", "created_tx_type", "created_tx_id", "created_block", "created_time", "initial_balance", "initial_weight", "bls_public_key"), F.struct("created_block", "created_tx_id", "validation_id")).alias("h")
    )
    rows = merge_full(now, past, keys)
    zero = F.lit(0).cast("decimal(20,0)")
    epoch = F.timestamp_seconds(F.lit(0))
    initial, balance = F.coalesce("h.initial_balance", zero), F.coalesce("s.balance", zero)
    fees, daily, left = _burn(initial, balance, "s.start_time", as_of)
    text = lambda c: c.cast("string")
    return rows.select(
        F.coalesce(F.nullif("s.validation_id", F.lit("")), F.nullif("h.validation_id", F.lit("")), F.lit("")).alias("validation_id"),
        "node_id",
        "subnet_id",
        text(F.coalesce("s.weight", "h.initial_weight", zero)).alias("weight"),
        text(balance).alias("balance"),
        fmt_time(F.coalesce("s.start_time", "h.created_time", epoch)).alias("start_time"),
        fmt_time(F.coalesce("s.end_time", epoch)).alias("end_time"),
        F.coalesce("s.uptime_percentage", F.lit(0.0)).alias("uptime_percentage"),
        F.coalesce("s.active", F.lit(False)).alias("active"),
        fmt_time(F.coalesce("s.last_updated", "h.created_time", _now(as_of))).alias("last_updated"),
        F.col("h.created_tx_type").alias("created_tx_type"),
        F.col("h.created_tx_id").alias("created_tx_id"),
        F.col("h.created_block").alias("created_block"),
        fmt_time("h.created_time").alias("created_time"),
        text(initial).alias("initial_balance"),
        text(F.coalesce("h.initial_weight", zero)).alias("initial_weight"),
        F.col("h.bls_public_key").alias("bls_public_key"),
        text(initial).alias("initial_deposit"),
        text(fees).alias("fees_paid"),
        F.coalesce(daily, F.lit(0.0)).alias("daily_burn_rate"),
        F.coalesce(left, F.lit(0.0)).alias("days_until_empty"),
    )


def validator_ledger(ledger: DataFrame, refunds: DataFrame, validation_id: str | None = None) -> DataFrame:
    """Deposits, top-ups and refunds of a validator (or all) in block order."""
    pick = lambda df: df if validation_id is None else df.where(F.col("validation_id") == validation_id)
    common = ["validation_id", "tx_id"]
    paid = pick(ledger).select(*common, "tx_type", F.col("block_number").alias("block_height"), fmt_time("block_time").alias("block_time"), F.col("amount").cast("string").alias("amount"), F.lit("").alias("refund_address"))
    back = pick(refunds).select(*common, F.lit("DisableL1Validator").alias("tx_type"), F.col("block_number").alias("block_height"), fmt_time("block_time").alias("block_time"), F.col("refund_amount").cast("string").alias("amount"), "refund_address")
    effect = F.when(F.col("tx_type") == "DisableL1Validator", "refund").when(F.col("tx_type") == "IncreaseL1ValidatorBalance", "top-up").otherwise("deposit")
    return paid.unionByName(back).withColumn("effect", effect).orderBy("block_height", "tx_id", "validation_id")


def ledger_totals(rows: DataFrame, state: DataFrame) -> DataFrame:
    """Per validator: initial deposit, top-ups, refund, and fees (funded less refund, or less balance while active)."""
    amount = F.col("amount").cast("decimal(38,0)")
    total = lambda effect: F.coalesce(F.sum(F.when(F.col("effect") == effect, amount)), F.lit(0)).cast("decimal(38,0)")
    sums = rows.groupBy("validation_id").agg(
        total("deposit").alias("initial_deposit"), total("top-up").alias("total_topups"), total("refund").alias("refund_amount"),
        F.count_if(F.col("effect") == "refund").alias("_refunds"),
    )
    held = state.groupBy("validation_id").agg(F.max("balance").cast("decimal(38,0)").alias("current_balance"))
    zero = F.lit(0).cast("decimal(38,0)")
    funded = F.col("initial_deposit") + F.col("total_topups")
    spent = funded - F.when(F.col("_refunds") > 0, F.col("refund_amount")).otherwise(F.coalesce("current_balance", zero))
    return sums.join(held, "validation_id", "left").select(
        "validation_id", "initial_deposit", "total_topups", "refund_amount", F.coalesce("current_balance", zero).alias("current_balance"),
        funded.alias("total_funded"), F.greatest(spent, zero).alias("fees_paid"),
    )


# --- platform blocks and transactions -------------------------------------------------------


def block_details(txs: DataFrame, block_number: int | None = None) -> DataFrame:
    """Block page header; one row per block if no number is given."""
    rows = txs if block_number is None else txs.where(F.col("block_number") == block_number)
    first = F.struct("tx_id")
    body = lambda p: F.min_by(json_field("tx_data", p), first)
    return rows.groupBy("block_number").agg(
        F.count("*").alias("tx_count"),
        fmt_time(F.max("block_time"), ISO_PATTERN).alias("block_time"),
        F.min("tx_id").alias("block_hash"),
        body("ParentID").alias("parent_id"),
        body("ProposerID").alias("proposer_id"),
        body("NodeID").alias("proposer_node_id"),
        F.min_by("tx_type", first).alias("block_type"),
    )


def block_txs(txs: DataFrame, block_number: int | None = None) -> DataFrame:
    rows = txs if block_number is None else txs.where(F.col("block_number") == block_number)
    return rows.orderBy("block_time", "tx_id").select("tx_id", "tx_type", fmt_time("block_time", ISO_PATTERN).alias("formatted_time"))


def tx_details(txs: DataFrame, tx_id: str) -> DataFrame:
    return find_one(txs, "tx_id", tx_id).select(
        "tx_id", "tx_type", "block_number", fmt_time("block_time", ISO_PATTERN).alias("formatted_time"), F.to_json("tx_data").alias("tx_data")
    )


# --- example queries ------------------------------------------------------------------------


def _ranged(df: DataFrame, chain_id: int | None, start) -> DataFrame:
    return in_time_range(for_chain(df, chain_id), "block_time", start)


def _per(df: DataFrame, granularity: str, name: str, *aggregates: Column, extra=()) -> DataFrame:
    keys = ["chain_id", period_start("block_time", granularity).alias(name), *extra]
    return df.groupBy(*keys).agg(*aggregates).orderBy("chain_id", name, *extra)


def txs_per_hour(txs: DataFrame, chain_id=None, start=None) -> DataFrame:
    return _per(_ranged(txs, chain_id, start), "hour", "hour", F.count("*").alias("tx_count"))


def logs_by_signature(logs: DataFrame, chain_id=None, signature: str = MESSAGE_SENT, start=None) -> DataFrame:
    rows = _ranged(logs, chain_id, start).where(bytes_in("topic0", [signature]))
    return rows.orderBy("block_time").select("block_number", "block_time", F.col("address").alias("contract_address"), "transaction_hash", "log_index")


def logs_per_day(logs: DataFrame, chain_id=None, signature: str = MESSAGE_RECEIVED, start=None) -> DataFrame:
    rows = _ranged(logs, chain_id, start).where(bytes_in("topic0", [signature]))
    return _per(rows, "day", "day", F.count("*").alias("receive_count"))


def gas_per_day(txs: DataFrame, chain_id=None, start=None) -> DataFrame:
    return _per(_ranged(txs, chain_id, start), "day", "day", F.sum("gas_used").alias("total_gas_used"))


def deployments(txs: DataFrame, chain_id=None, start=None) -> DataFrame:
    rows = _ranged(txs, chain_id, start).where(F.col("to").isNull() & F.col("success"))
    return rows.orderBy("block_time").select("block_number", "block_time", F.col("hash").alias("tx_hash"), F.col("from").alias("deployer"), "contract_address")


def senders_per_day(txs: DataFrame, chain_id=None, start=None, approx: bool = False) -> DataFrame:
    count = F.approx_count_distinct("from") if approx else F.count_distinct("from")
    return _per(_ranged(txs, chain_id, start), "day", "day", count.alias("unique_senders"))


def gas_price_per_hour(txs: DataFrame, chain_id=None, start=None) -> DataFrame:
    return _per(
        _ranged(txs, chain_id, start), "hour", "hour", F.avg(F.col("gas_price").cast("double")).alias("avg_gas_price"), F.max("gas_price").alias("max_gas_price")
    )


def contract_events(logs: DataFrame, chain_id=None, address: str | None = None, start=None) -> DataFrame:
    rows = _ranged(logs, chain_id, start)
    if address is not None:
        rows = rows.where(bytes_in("address", [address]))
    topics = [c for c in ("topic0", "topic1", "topic2", "topic3") if c in logs.columns]
    return rows.orderBy("block_number", "log_index").select("block_number", "block_time", "transaction_hash", "log_index", *topics, "data")


def value_per_day(txs: DataFrame, chain_id=None, start=None) -> DataFrame:
    rows = _ranged(txs, chain_id, start).where(F.col("value") > u256_lit(0))
    return _per(rows, "day", "day", u256_sum("value").alias("total_value_transferred"))


def creates_per_day(traces: DataFrame, chain_id=None, start=None) -> DataFrame:
    rows = _ranged(traces, chain_id, start).where(F.col("call_type").isin(*CREATE_CALLS))
    return _per(rows, "day", "day", F.count("*").alias("create_count"), extra=("call_type",))


def messages_per_week(logs: DataFrame, chain_id=None, start=None) -> DataFrame:
    rows = _ranged(logs, chain_id, start).where(bytes_in("topic0", [MESSAGE_SENT, MESSAGE_RECEIVED]))
    return _per(rows, "week", "week", F.count("*").alias("total_icm_messages"))


def token_transfers(logs: DataFrame, token: str | None, decimals: int, granularity: str, chain_id=None, start=None, approx: bool = False) -> DataFrame:
    """Transfers of a token per period: count, senders, whole coins to two decimals."""
    rows = _ranged(logs, chain_id, start).where(bytes_in("topic0", [TRANSFER]))
    if token is not None:
        rows = rows.where(bytes_in("address", [token]))
    sized = byte_length("data") == 32
    senders = F.approx_count_distinct("tx_from") if approx else F.count_distinct("tx_from")
    out = rows.groupBy("chain_id", period_start("block_time", granularity).alias("period")).agg(
        F.count("*").alias("transfer_count"), senders.alias("unique_senders"), u256_sum("data", sized).alias("total")
    )
    amount = F.round(u256_to_double("total") / float(10**decimals), 2)
    return out.select("chain_id", "period", "transfer_count", "unique_senders", amount.alias("total_amount"))


def latest_blocks(blocks: DataFrame, k: int = 5) -> DataFrame:
    rows = top_k(blocks, "block_number", k, ["chain_id"])
    hexed = [to_hex(c).alias(c) for c in ("hash", "parent_hash") if c in blocks.columns]
    plain = [c for c in ("gas_used", "gas_limit") if c in blocks.columns]
    return rows.select("chain_id", "block_number", "block_time", *hexed, *plain)


def tx_sample(txs: DataFrame, k: int = 10) -> DataFrame:
    """The newest transactions with readable bytes; sorted so that the sample is repeatable."""
    rows = txs.orderBy(F.desc("block_number"), "transaction_index", "hash", "from", "to", "value").limit(k)
    hexed = [to_hex(c).alias(c) for c in ("hash", "from", "to")]
    return rows.select("block_number", "transaction_index", *hexed, u256_to_text("value").alias("value"), "gas_used")


def run_sql(spark: SparkSession, text: str, args: dict | None = None, template: dict | None = None) -> DataFrame:
    """Ad-hoc SQL over the registered views: {name} placeholders are replaced, :name parameters are bound."""
    for key, value in (template or {}).items():
        text = text.replace("{" + key + "}", str(value))
    return spark.sql(text, args=args or {})

