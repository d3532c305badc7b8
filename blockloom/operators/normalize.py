"""Nested block records to the four flat fact tables.

The step in the middle is a *transaction row*: chain_id, block (header), pos, tx, receipt,
trace.  It is made from nested records without a shuffle, or by joining flat receipts and
traces; the flat tables are projections of it.  All decoding is JVM expressions; Python
only walks call trees, whose depth no expression can follow.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockloom.constants import LAUNCH_SECONDS, SECONDS_PER_BLOCK, TIME_LOOKBACK_BLOCKS, ZERO_HASH
from blockloom.functions.hexes import bytes_of, digits, fixed_of, from_hex, hex_to_fixed, uint_of
from blockloom.functions.periods import block_time
from blockloom.functions.text import json_field
from blockloom.operators.windows import last_known


def _chain(chain_id) -> Column:
    return (chain_id if isinstance(chain_id, Column) else F.lit(chain_id)).cast("bigint")


def _or_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def _or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(b""))


def _stripped(df: DataFrame, keep: list, fields: dict[str, str]) -> DataFrame:
    """Bare hex digits of the fields (new name -> path), next to the kept columns."""
    return df.select(*keep, *[digits(path).alias(name) for name, path in fields.items()])


_TIME_FIELDS = {"b_number": "block.number", "b_hash": "block.hash", "b_time": "block.timestamp", "b_ms": "block.timestampMilliseconds"}


def _time() -> Column:
    return block_time(_or_zero(uint_of("b_ms", kind="bigint")), uint_of("b_time", strict=True, kind="bigint"))


def _number() -> Column:
    return uint_of("b_number", 32, strict=True)


def normalize_blocks(df: DataFrame, chain_id) -> DataFrame:
    """Block headers in the raw_blocks layout."""
    names = [
        "parentHash", "miner", "difficulty", "totalDifficulty", "size", "gasLimit", "gasUsed", "baseFeePerGas", "blockGasCost", "stateRoot",
        "transactionsRoot", "receiptsRoot", "extraData", "blockExtraData", "extDataHash", "extDataGasUsed", "mixHash", "nonce", "sha3Uncles",
        "blobGasUsed", "excessBlobGas", "parentBeaconBlockRoot", "minDelayExcess",
    ]
    uncles = F.transform(F.coalesce("block.uncles", F.expr("cast(array() as array<string>)")), lambda u: hex_to_fixed(u, 32, strict=True))
    keep = [_chain(chain_id).alias("chain_id"), uncles.alias("uncles")]
    bare = _stripped(df, keep, {**_TIME_FIELDS, **{n: f"block.{n}" for n in names}})
    quantity = lambda n: _or_zero(uint_of(n)).cast("decimal(20,0)")
    return bare.select(
        "chain_id",
        _number().alias("block_number"),
        fixed_of("b_hash", 32, strict=True).alias("hash"),
        fixed_of("parentHash", 32, strict=True).alias("parent_hash"),
        _time().alias("block_time"),
        fixed_of("miner", 20, strict=True).alias("miner"),
        F.when(quantity("difficulty") > 1, 2).otherwise(1).alias("difficulty"),
        F.coalesce(uint_of("totalDifficulty"), _number().cast("decimal(20,0)")).alias("total_difficulty"),
        uint_of("size", 32, strict=True).alias("size"),
        uint_of("gasLimit", 32, strict=True).alias("gas_limit"),
        uint_of("gasUsed", 32, strict=True).alias("gas_used"),
        quantity("baseFeePerGas").alias("base_fee_per_gas"),
        quantity("blockGasCost").alias("block_gas_cost"),
        fixed_of("stateRoot", 32, strict=True).alias("state_root"),
        fixed_of("transactionsRoot", 32, strict=True).alias("transactions_root"),
        fixed_of("receiptsRoot", 32, strict=True).alias("receipts_root"),
        _or_empty(bytes_of("extraData")).alias("extra_data"),
        _or_empty(bytes_of("blockExtraData")).alias("block_extra_data"),
        F.coalesce(fixed_of("extDataHash", 32), from_hex(ZERO_HASH)).alias("ext_data_hash"),
        _or_zero(uint_of("extDataGasUsed", 32)).alias("ext_data_gas_used"),
        fixed_of("mixHash", 32, strict=True).alias("mix_hash"),
        fixed_of("nonce", 8, strict=True).alias("nonce"),
        fixed_of("sha3Uncles", 32, strict=True).alias("sha3_uncles"),
        "uncles",
        _or_zero(uint_of("blobGasUsed", 32)).alias("blob_gas_used"),
        quantity("excessBlobGas").alias("excess_blob_gas"),
        F.coalesce(fixed_of("parentBeaconBlockRoot", 32), from_hex(ZERO_HASH)).alias("parent_beacon_block_root"),
        uint_of("minDelayExcess", strict=True).alias("min_delay_excess"),
    )


_HEADER = ["number", "hash", "timestamp", "timestampMilliseconds", "baseFeePerGas"]


def _header() -> Column:
    return F.struct(*[F.col(f"block.{f}").alias(f) for f in _HEADER]).alias("block")


# What the flat tables read of receipts and traces.
TX_PARTS = {"receipt": ("status", "gasUsed", "contractAddress"), "trace": ("txHash",)}
TRACE_PARTS = {"receipt": ("status",), "trace": ("result",)}


def tx_rows(df: DataFrame, chain_id, strict: bool = True, parts: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Transaction rows of nested records: receipt i and trace i belong to transaction i.

    A block whose receipt count differs from its transaction count is an error if ``strict``,
    otherwise it is left out (``receipt_mismatch`` lists those).  ``parts`` names the only fields that
    receipts and traces are to have; the others are neither read nor carried through the explosion,
    behind which Spark prunes nothing.
    """
    lists, records = {"tx": "block.transactions"}, [F.col("item.tx")]
    for name, source in (("receipt", "receipts"), ("trace", "traces")):
        if parts is None:
            lists[name] = source
            records.append(F.col(f"item.{name}"))
        else:
            lists |= {f"{name}_{f}": f"{source}.{f}" for f in parts[name]}
            records.append(F.struct(*[F.col(f"item.{name}_{f}").alias(f) for f in parts[name]]).alias(name))
    receipts = next(n for n in lists if n.startswith("receipt"))
    # the check is part of the exploded value, not a filter: a filter on array sizes would be pushed
    # down and make the scan side build the arrays twice
    ok = F.coalesce(F.size("tx"), F.lit(0)) == F.coalesce(F.size(receipts), F.lit(0))
    zipped = F.when(ok, F.arrays_zip(*lists))
    if strict:
        message = F.concat(F.lit("receipt count differs in block "), F.col("block.number"))
        zipped = zipped.otherwise(F.raise_error(message).cast("void"))
    return (
        df.select(_chain(chain_id).alias("chain_id"), _header(), *[F.col(path).alias(n) for n, path in lists.items()])
        .select("chain_id", "block", F.posexplode(zipped).alias("pos", "item"))
        .select("chain_id", "block", "pos", *records)
        .where(F.col("tx").isNotNull())
    )


def assemble_blocks(blocks: DataFrame, receipts: DataFrame, traces: DataFrame, chain_id, strict: bool = True) -> DataFrame:
    """Transaction rows from blocks and separately delivered receipts and traces.

    A transaction without a receipt is an error (or dropped if not ``strict``); a missing trace stays NULL.
    """
    txs = blocks.select(_chain(chain_id).alias("chain_id"), _header(), F.posexplode("block.transactions").alias("pos", "tx"))
    txs = txs.withColumn("_hash", F.col("tx.hash"))
    # a mark tells whether there is a receipt: a check of the receipt itself would carry all of it through the joins
    keyed = receipts.select(F.col("receipt.transactionHash").alias("_hash"), F.col("receipt"), F.lit(True).alias("_found"))
    calls = traces.select(F.col("trace.txHash").alias("_hash"), F.col("trace"))
    if not strict:
        return txs.join(keyed, "_hash").join(calls, "_hash", "left").drop("_hash", "_found")
    rows = txs.join(keyed, "_hash", "left").join(calls, "_hash", "left")
    message = F.concat(F.lit("no receipt for transaction "), F.col("_hash"))
    return rows.where(
        F.when(F.col("_found"), True).otherwise(F.raise_error(message).cast("boolean"))
    ).drop("_hash", "_found")


def priority_fee(gas_price, base_fee, max_priority) -> Column:
    """0 before base fees existed, else gas price less base fee, capped by a positive maximum."""
    p, b, m = [(F.col(c) if isinstance(c, str) else c).cast("decimal(20,0)") for c in (gas_price, base_fee, max_priority)]
    zero = F.lit(0).cast("decimal(20,0)")
    tip = F.greatest(zero, (p - b).cast("decimal(20,0)"))
    return F.when(b == 0, zero).when((m > 0) & (tip > m), m).otherwise(tip)


def access_list(c) -> Column:
    """Access-list JSON to an array of (address, storage_keys); a bad address drops its entry, a bad key is NULL."""
    parsed = F.from_json(c, "array<struct<address:string, storageKeys:array<string>>>")
    entries = F.transform(
        parsed,
        lambda e: F.struct(
            hex_to_fixed(e["address"], 20).alias("address"),
            F.transform(
                F.coalesce(e["storageKeys"], F.expr("cast(array() as array<string>)")), lambda k: hex_to_fixed(k, 32)
            ).alias("storage_keys"),
        ),
    )
    kept = F.filter(entries, lambda e: e["address"].isNotNull())
    return F.coalesce(kept, F.expr("cast(array() as array<struct<address:binary, storage_keys:array<binary>>>)"))


def _optional_fixed(h: str, size: int, strict: bool) -> Column:
    return F.when(F.col(h) != "", fixed_of(h, size, strict))


def normalize_txs(rows: DataFrame) -> DataFrame:
    """Transaction rows in the raw_txs layout."""
    fields = {n: f"tx.{n}" for n in ("hash", "transactionIndex", "nonce", "from", "to", "value", "gas", "gasPrice", "input", "type", "maxFeePerGas", "maxPriorityFeePerGas")}
    fields |= {"receiptGas": "receipt.gasUsed", "contract": "receipt.contractAddress", "baseFee": "block.baseFeePerGas"}
    given = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    keep = [
        "chain_id",
        F.coalesce(F.col("receipt.status") == "0x1", F.lit(False)).alias("success"),
        given("tx.maxFeePerGas").alias("has_max_fee"),
        given("tx.maxPriorityFeePerGas").alias("has_max_priority"),
        access_list(F.col("tx.accessList")).alias("access_list"),
    ]
    bare = _stripped(rows, keep, {**_TIME_FIELDS, **fields})
    decoded = bare.select(
        "chain_id",
        fixed_of("hash", 32, strict=True).alias("hash"),
        _number().alias("block_number"),
        fixed_of("b_hash", 32, strict=True).alias("block_hash"),
        _time().alias("block_time"),
        uint_of("transactionIndex", 16, strict=True).alias("transaction_index"),
        uint_of("nonce", strict=True).alias("nonce"),
        fixed_of("from", 20, strict=True).alias("from"),
        _optional_fixed("to", 20, True).alias("to"),
        fixed_of("value", 32, strict=True).alias("value"),
        uint_of("gas", 32, strict=True).alias("gas_limit"),
        uint_of("gasPrice", strict=True).alias("gas_price"),
        uint_of("receiptGas", 32, strict=True).alias("gas_used"),
        "success",
        bytes_of("input", strict=True).alias("input"),
        _or_zero(uint_of("type", 8)).alias("type"),
        F.when(F.col("has_max_fee"), uint_of("maxFeePerGas")).alias("max_fee_per_gas"),
        F.when(F.col("has_max_priority"), uint_of("maxPriorityFeePerGas")).alias("max_priority_fee_per_gas"),
        _or_zero(uint_of("baseFee")).cast("decimal(20,0)").alias("base_fee_per_gas"),
        _optional_fixed("contract", 20, False).alias("contract_address"),
        "access_list",
    )
    tip = F.when(F.col("max_priority_fee_per_gas").isNotNull(), priority_fee("gas_price", "base_fee_per_gas", "max_priority_fee_per_gas"))
    order = decoded.columns
    at = order.index("base_fee_per_gas")
    return decoded.withColumn("priority_fee_per_gas", tip).select(*order[:at], "priority_fee_per_gas", *order[at:])


CALL = """array<struct<path:array<int>, `from`:string, `to`:string, gas:string, gasUsed:string, value:string,
 input:string, output:string, type:string>>"""
_CALL_FIELDS = ("from", "to", "gas", "gasUsed", "value", "input", "output", "type")


def _walk(texts: pa.Array) -> pa.Array:
    """Calls of each trace in pre-order with their paths, gathered by field: no record is made of a call."""
    calls, paths, path_ends, ends, absent = [], array("i"), array("i", [0]), array("i", [0]), []
    for text in texts:
        text = text.as_py()
        root = json.loads(text) if text else None
        absent.append(not root)
        stack = [((), root)] if root else []
        while stack:
            path, call = stack.pop()
            children = call.get("calls") or []
            calls.append(call)
            paths.extend(path)
            path_ends.append(len(paths))
            if children:
                stack.extend([(path + (i,), child) for i, child in enumerate(children)][::-1])
        ends.append(len(calls))
    numbers = lambda a: pa.array(a, pa.int32())
    fields = [pa.array([call.get(f) for call in calls], pa.string(), from_pandas=True) for f in _CALL_FIELDS]
    records = pa.StructArray.from_arrays([pa.ListArray.from_arrays(numbers(path_ends), numbers(paths)), *fields], ["path", *_CALL_FIELDS])
    return pa.ListArray.from_arrays(numbers(ends), records, mask=pa.array(absent, pa.bool_()))


def call_list(trace: Column) -> Column:
    """Trace JSON to the array of its calls."""

    @F.arrow_udf(CALL)
    def walk(texts: pa.Array) -> pa.Array:
        return _walk(texts)

    return walk(trace)


def flatten_traces(rows: DataFrame, trace: str = "trace.result") -> DataFrame:
    """One row per call of each trace, in column ``call``; rows without a trace vanish."""
    kept = rows.where(F.col(trace).isNotNull())
    return kept.withColumn("call", F.explode(call_list(F.col(trace))))


def normalize_traces(rows: DataFrame, each_tx: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Transaction rows in the raw_traces layout (one row per call).

    ``each_tx`` gives the columns of a transaction another form, once and not for each of its calls.
    """
    keep = [
        "chain_id",
        F.col("pos").cast("int").alias("transaction_index"),
        F.coalesce(F.col("receipt.status") == "0x1", F.lit(False)).alias("tx_success"),
        F.col("trace.result").alias("_trace"),
    ]
    bare = _stripped(rows, keep, {**_TIME_FIELDS, "t_hash": "tx.hash", "t_from": "tx.from", "t_to": "tx.to"})
    slim = bare.select(
        "chain_id",
        fixed_of("t_hash", 32, strict=True).alias("tx_hash"),
        _number().alias("block_number"),
        _time().alias("block_time"),
        "transaction_index",
        "tx_success",
        fixed_of("t_from", 20, strict=True).alias("tx_from"),
        _optional_fixed("t_to", 20, False).alias("tx_to"),
        "_trace",
    )
    calls = flatten_traces(each_tx(slim) if each_tx else slim, "_trace")
    kept = [c for c in slim.columns if c != "_trace"]
    keep = [*kept, F.col("call.path").alias("path"), F.upper(F.coalesce("call.type", F.lit(""))).alias("kind")]
    bare_calls = _stripped(calls, keep, {n: f"call.{n}" for n in ("from", "to", "gas", "gasUsed", "value", "input", "output")})
    return bare_calls.select(
        "chain_id",
        "tx_hash",
        "block_number",
        "block_time",
        "transaction_index",
        F.col("path").alias("trace_address"),
        fixed_of("from", 20, strict=True).alias("from"),
        fixed_of("to", 20, strict=True).alias("to"),  # no recipient: zero bytes
        _or_zero(uint_of("gas", 32)).alias("gas"),
        _or_zero(uint_of("gasUsed", 32)).alias("gas_used"),
        F.coalesce(fixed_of("value", 32), from_hex(ZERO_HASH)).alias("value"),
        _or_empty(bytes_of("input")).alias("input"),
        _or_empty(bytes_of("output")).alias("output"),
        F.when(F.col("kind") == "", "CALL").otherwise(F.col("kind")).alias("call_type"),
        "tx_success",
        "tx_from",
        "tx_to",
    )


def normalize_logs(rows: DataFrame) -> DataFrame:
    """Transaction rows in the raw_logs layout (one row per log)."""
    header = _stripped(rows, ["chain_id", "receipt.logs"], {**_TIME_FIELDS, "t_from": "tx.from", "t_to": "tx.to"}).select(
        "chain_id",
        _number().alias("block_number"),
        fixed_of("b_hash", 32, strict=True).alias("block_hash"),
        _time().alias("block_time"),
        fixed_of("t_from", 20, strict=True).alias("tx_from"),
        _optional_fixed("t_to", 20, False).alias("tx_to"),
        "logs",
    )
    kept = [c for c in header.columns if c != "logs"]
    logs = header.select(*kept, F.explode("logs").alias("log"))
    topics = [F.coalesce(F.get("log.topics", F.lit(i)), F.lit("")).alias(f"topic{i}") for i in range(4)]
    named = logs.select(*kept, "log.*", *topics)
    fields = ("address", "transactionHash", "transactionIndex", "logIndex", "data", "topic0", "topic1", "topic2", "topic3")
    keep = [*kept, "removed", *[(F.col(f"topic{i}") != "").alias(f"has{i}") for i in range(4)]]
    bare = _stripped(named, keep, {f: f for f in fields})
    topic = lambda i: F.when(F.col(f"has{i}"), fixed_of(f"topic{i}", 32)).alias(f"topic{i}")
    return bare.select(
        "chain_id",
        fixed_of("address", 20, strict=True).alias("address"),
        "block_number",
        "block_hash",
        "block_time",
        fixed_of("transactionHash", 32, strict=True).alias("transaction_hash"),
        uint_of("transactionIndex", 16, strict=True).alias("transaction_index"),
        uint_of("logIndex", 32, strict=True).alias("log_index"),
        "tx_from",
        "tx_to",
        fixed_of("topic0", 32, strict=True).alias("topic0"),  # an anonymous event: zero bytes
        topic(1),
        topic(2),
        topic(3),
        _or_empty(bytes_of("data")).alias("data"),
        F.coalesce("removed", F.lit(False)).alias("removed"),
    )


def fill_block_time(df: DataFrame, chain: str = "p_chain_id", height: str = "height", width: int | None = 10_000) -> DataFrame:
    """Fill NULL block_time from the last advance_time at most 100 blocks back, else from the height."""
    known = last_known(df, "advance_time", height, [chain], TIME_LOOKBACK_BLOCKS, "_known", width)
    estimate = F.timestamp_seconds(F.col(height) * SECONDS_PER_BLOCK + LAUNCH_SECONDS)
    return known.withColumn("block_time", F.coalesce("block_time", "_known", estimate)).drop("_known")


# Where each transaction type keeps its fields.
_STAKER = {"node_id": "validator.nodeID", "start_time": "validator.start", "end_time": "validator.end", "weight": "validator.weight"}
PLATFORM_FIELDS = {
    "ConvertSubnetToL1": {"subnet_id": "subnetID", "chain_id": "chainID", "address": "address", "validators": "validators"},
    "AddValidator": _STAKER,
    "AddDelegator": _STAKER,
    "CreateSubnet": {"owner": "owner"},
    "CreateChain": {
        "subnet_id": "subnetID",
        "chain_name": "chainName",
        "genesis_data": "genesisData",
        "vm_id": "vmID",
        "fx_ids": "fxIDs",
        "subnet_auth": "subnetAuthorization",
    },
    "Import": {"source_chain": "sourceChain"},
    "Export": {"destination_chain": "destinationChain"},
    "AddSubnetValidator": {**_STAKER, "subnet_id": "validator.subnetID"},
    "RemoveSubnetValidator": {"subnet_id": "subnetID", "node_id": "nodeID"},
    "TransformSubnet": {
        "subnet_id": "subnetID",
        "asset_id": "assetID",
        "initial_supply": "initialSupply",
        "max_supply": "maximumSupply",
        "min_consumption_rate": "minConsumptionRate",
        "max_consumption_rate": "maxConsumptionRate",
        "min_validator_stake": "minValidatorStake",
        "max_validator_stake": "maxValidatorStake",
        "min_stake_duration": "minStakeDuration",
        "max_stake_duration": "maxStakeDuration",
        "min_delegation_fee": "minDelegationFee",
        "min_delegator_stake": "minDelegatorStake",
        "max_validator_weight_factor": "maxValidatorWeightFactor",
        "uptime_requirement": "uptimeRequirement",
    },
    "TransferSubnetOwnership": {"subnet_id": "subnetID", "owner": "newOwner"},
    "AddPermissionlessValidator": {
        **_STAKER,
        "subnet_id": "subnetID",
        "signer": "signer",
        "stake_outs": "stake",
        "validator_rewards_owner": "validationRewardsOwner",
        "delegation_shares": "shares",
    },
    "AddPermissionlessDelegator": {
        **_STAKER,
        "subnet_id": "subnetID",
        "stake_outs": "stake",
        "delegator_rewards_owner": "rewardsOwner",
    },
    "RewardValidator": {"reward_tx_id": "txID"},
    "IncreaseL1ValidatorBalance": {"validation_id": "validationID", "balance": "balance"},
    "SetL1ValidatorWeight": {"message": "message"},
    "AdvanceTime": {"time": "time"},
    "Base": {},
}
_NUMBERS = {
    "start_time", "end_time", "weight", "balance", "time", "initial_supply", "max_supply", "min_consumption_rate",
    "max_consumption_rate", "min_validator_stake", "max_validator_stake", "min_stake_duration", "max_stake_duration",
    "min_delegation_fee", "min_delegator_stake", "max_validator_weight_factor", "uptime_requirement", "delegation_shares",
}


def platform_tx_fields(txs: DataFrame) -> DataFrame:
    """Type-specific fields of platform transactions as columns, NULL where a type has no such field."""
    paths: dict[str, dict[str, list[str]]] = {}
    for kind, fields in PLATFORM_FIELDS.items():
        for name, path in fields.items():
            paths.setdefault(name, {}).setdefault(path, []).append(kind)
    out = []
    for name, by_path in paths.items():
        value = None
        for path, kinds in by_path.items():
            # numbers may be JSON numbers or text, so they are read as text first
            field = json_field("tx_data", path)
            if name in _NUMBERS:
                field = field.try_cast("decimal(20,0)")
            value = F.when(F.col("tx_type").isin(kinds), field) if value is None else value.when(F.col("tx_type").isin(kinds), field)
        out.append(value.alias(name))
    return txs.select(*[c for c in txs.columns if c != "tx_data"], *out)


def explode_validators(conversions: DataFrame) -> DataFrame:
    """One row per validator of a conversion transaction, with its position in column ``ordinal``."""
    rows = conversions.withColumn("_list", json_field("tx_data", "validators", "array<variant>"))
    return rows.select(
        *[c for c in conversions.columns if c != "tx_data"],
        json_field("tx_data", "subnetID").alias("subnet_id"),
        F.posexplode("_list").alias("ordinal", "validator"),
    )

