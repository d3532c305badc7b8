"""The test tables (a TPC-H-like star schema plus an event stream) in the shape of chain tables.

Every mapping is one projection without a shuffle, so the queries over it keep the cost
profile they have on real chain tables.  ``SQL`` holds the same mappings for the DuckDB
check, with addresses as plain numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from blockloom import schemas
from blockloom.constants import DEPOSIT, MESSAGE_RECEIVED, MESSAGE_SENT, TRANSFER, USDC_ADDRESS, WITHDRAWAL
from blockloom.functions.hexes import address_of, from_hex, hash_of, text_of, wide_of
from blockloom.functions.u256 import u256_from_words
from blockloom.session import scratch


# One type per last digit of the order number.
PLATFORM_TYPES = (
    "CreateChainTx", "ConvertSubnetToL1Tx", "IncreaseL1ValidatorBalanceTx", "DisableL1ValidatorTx", "AddSubnetValidatorTx",
    "TransformSubnetTx", "RegisterL1ValidatorTx", "AdvanceTimeTx", "ImportTx", "ExportTx",
)


def _cents(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("bigint")


def _spread(day: str, number: Column) -> Column:
    """A day column plus a second of the day taken from a number, so that buckets below a day are filled."""
    return F.timestamp_seconds(F.unix_timestamp(F.col(day).cast("timestamp")) + F.pmod(number, F.lit(86400)))


def _seconds(ts: Column) -> Column:
    return F.unix_timestamp(ts)


def _order_time() -> Column:
    return _spread("o_orderdate", F.col("o_orderkey") * 7919)


def _event_chain() -> Column:
    return F.pmod("user_id", F.lit(3)) + 1


def _subnet(number: Column) -> Column:
    return F.concat(F.lit("subnet"), number.cast("string"))


def _node(number: Column, i: int) -> Column:
    return F.concat(F.lit(f"NodeID-{i}-"), F.lpad(number.cast("string"), 26, "1"))


def _validation(number: Column, i: int) -> Column:
    return F.concat(F.lit(f"val{i}x"), number.cast("string"))


class Star:
    """The tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def spread(self, name: str) -> DataFrame:
        """The table over all cores, for mappings that compute much per row.

        Only a table in fewer files than there are cores is redistributed; a large input has
        more splits than cores and passes unchanged.
        """
        df = self.table(name)
        cores = self.spark.sparkContext.defaultParallelism
        return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df

    def spread_by(self, name: str, key: str) -> DataFrame:
        """The same by ranges of a key, so that neighbours stay together and writes by ranges of it give few files."""
        df = self.table(name)
        cores = self.spark.sparkContext.defaultParallelism
        return df.repartitionByRange(cores, key) if df.rdd.getNumPartitions() < cores else df

    # --- EVM tables ---------------------------------------------------------------

    def raw_txs(self) -> DataFrame:
        """lineitem: chain = line number, block = order, sender = part, recipient = supplier (none without discount)."""
        cents = _cents("l_extendedprice")
        return self.spread("lineitem").select(
            F.col("l_linenumber").cast("bigint").alias("chain_id"),
            hash_of(F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("hash"),
            F.col("l_orderkey").alias("block_number"),
            _spread("l_shipdate", F.col("l_orderkey") * 7919 + F.col("l_partkey") * 31).alias("block_time"),
            F.col("l_linenumber").alias("transaction_index"),
            address_of("l_partkey").alias("from"),
            F.when(F.col("l_discount") != 0, address_of("l_suppkey")).alias("to"),
            u256_from_words(cents, F.col("l_partkey")).alias("value"),
            cents.alias("gas_price"),
            (F.lit(21000) + F.col("l_quantity").cast("bigint") * 100).alias("gas_used"),
            (F.col("l_linestatus") == "O").alias("success"),
            F.when(F.col("l_discount") == 0, address_of(F.col("l_orderkey"))).alias("contract_address"),
        )

    def raw_blocks(self) -> DataFrame:
        """orders: chain = priority digit, gas = price."""
        return self.table("orders").select(
            F.substring("o_orderpriority", 1, 1).cast("bigint").alias("chain_id"),
            F.col("o_orderkey").alias("block_number"),
            _spread("o_orderdate", F.col("o_orderkey") * 7919).alias("block_time"),
            F.floor("o_totalprice").cast("bigint").alias("gas_used"),
            hash_of("o_orderkey").alias("hash"),
            hash_of(F.greatest(F.col("o_orderkey") - 1, F.lit(0))).alias("parent_hash"),
        )

    def raw_traces(self) -> DataFrame:
        """events: caller = user, call type by event type."""
        kind = F.col("event_type")
        return self.table("events").select(
            _event_chain().alias("chain_id"),
            F.col("event_id").alias("block_number"),
            F.col("ts").cast("timestamp").alias("block_time"),
            F.pmod("event_id", F.lit(3)).cast("int").alias("transaction_index"),
            F.array(F.pmod("user_id", F.lit(3)).cast("int"), F.pmod("event_id", F.lit(5)).cast("int")).alias("trace_address"),
            address_of("user_id").alias("from"),
            F.when(kind != "error", address_of(F.pmod(_cents("value"), F.lit(1000)))).alias("to"),
            F.when(kind == "click", "CALL").when(kind == "view", "STATICCALL").when(kind == "purchase", "CREATE")
            .when(kind == "signup", "CREATE2").otherwise("DELEGATECALL").alias("call_type"),
            (F.col("value") >= 5).alias("tx_success"),
        )

    def message_logs(self) -> DataFrame:
        """events: clicks send, views receive, the rest transfers; purchases transfer the stable coin."""
        kind = F.col("event_type")
        return self.table("events").select(
            _event_chain().alias("chain_id"),
            F.col("event_id").alias("block_number"),
            F.col("ts").cast("timestamp").alias("block_time"),
            F.when(kind == "purchase", from_hex(USDC_ADDRESS)).otherwise(address_of("user_id")).alias("address"),
            hash_of("event_id").alias("transaction_hash"),
            F.pmod("event_id", F.lit(4)).alias("log_index"),
            F.when(kind == "click", from_hex(MESSAGE_SENT)).when(kind == "view", from_hex(MESSAGE_RECEIVED))
            .otherwise(from_hex(TRANSFER)).alias("topic0"),
            address_of("user_id").alias("tx_from"),
            hash_of(_cents("value") * 10000).alias("data"),
        )

    def token_logs(self) -> DataFrame:
        """lineitem: token = supplier, sender wallet = part, recipient wallet = order; untaxed rows carry 33 bytes."""
        flag = F.col("l_returnflag")
        word = u256_from_words(_cents("l_extendedprice"), F.col("l_partkey"))
        return self.spread("lineitem").select(
            F.col("l_linenumber").cast("bigint").alias("chain_id"),
            F.col("l_orderkey").alias("block_number"),
            _spread("l_shipdate", F.col("l_orderkey") * 7919 + F.col("l_partkey") * 31).alias("block_time"),
            address_of(F.col("l_suppkey") + 1).alias("address"),
            hash_of(F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("transaction_hash"),
            F.col("l_linenumber").cast("bigint").alias("log_index"),
            address_of("l_partkey").alias("tx_from"),
            F.when(flag == "A", from_hex(TRANSFER)).when(flag == "N", from_hex(DEPOSIT)).otherwise(from_hex(WITHDRAWAL)).alias("topic0"),
            hash_of("l_partkey").alias("topic1"),
            hash_of("l_orderkey").alias("topic2"),
            F.when(F.col("l_tax") == 0, F.concat(word, F.lit(b"\x00"))).otherwise(word).alias("data"),
        )

    # --- platform chain -----------------------------------------------------------

    def _platform_rows(self) -> DataFrame:
        """orders: one transaction per order, type by order number, subnet = customer."""
        key, cust = F.col("o_orderkey"), F.col("o_custkey")
        kind = F.pmod(key, F.lit(10))
        subnet, cents = _subnet(cust), _cents("o_totalprice")
        validator = lambda i: F.struct(
            _node(cust, i).alias("nodeID"),
            _validation(cust, i).alias("validationID"),
            (cents + i).alias("weight"),
            (cents * 1000 * i).alias("balance"),
            F.struct(F.concat(F.lit("0xb"), key.cast("string")).alias("publicKey")).alias("signer"),
            F.struct(F.lit(1).alias("threshold"), F.array(F.concat(F.lit("P-"), cust.cast("string"))).alias("addresses")).alias("remainingBalanceOwner"),
        )
        staker = F.struct(
            subnet.alias("subnetID"),
            _node(cust, 1).alias("nodeID"),
            (key + 1600000000).cast("string").alias("start"),
            (key + 1700000000).cast("string").alias("end"),
            cents.cast("string").alias("weight"),
        )
        body = F.struct(
            F.when(kind.isin(0, 1, 4, 5), subnet).alias("subnetID"),
            F.when(kind == 1, F.concat(F.lit("chain"), cust.cast("string"))).alias("chainID"),
            F.when(kind == 0, F.concat(F.lit("Chain "), key.cast("string"))).alias("chainName"),
            F.when(kind == 0, F.concat(F.lit("vm"), F.pmod(key, F.lit(7)).cast("string"))).alias("vmID"),
            F.when(kind == 1, F.array(validator(0), validator(1))).alias("validators"),
            F.when(kind.isin(2, 3), _validation(cust, 1)).alias("validationID"),
            F.when(kind.isin(2, 6), (cents * 100).cast("string")).alias("balance"),
            F.when(kind == 4, staker).alias("validator"),
            F.when(kind == 7, _seconds(_order_time())).alias("time"),
            F.when(kind == 8, F.lit("X")).alias("sourceChain"),
            F.when(kind == 9, F.lit("C")).alias("destinationChain"),
        )
        types = F.array(*[F.lit(t) for t in PLATFORM_TYPES])
        return self.spread("orders").select(
            key.alias("height"),
            _order_time().alias("block_time"),
            F.concat(F.lit("tx"), key.cast("string")).alias("txID"),
            F.get(types, kind.cast("int")).alias("txType"),
            F.to_json(body).alias("txData"),
        )

    def platform_blocks(self) -> DataFrame:
        """One block per order; one block in five lacks its time."""
        return self._platform_rows().select(
            F.concat(F.lit("b"), F.col("height").cast("string")).alias("blockID"),
            "height",
            F.when(F.pmod("height", F.lit(5)) != 3, _seconds(F.col("block_time"))).alias("timestamp"),
            F.array(F.struct("txID", "txType", "txData")).alias("transactions"),
        )

    def platform_txs(self) -> DataFrame:
        """The same orders as stored platform transactions."""
        return self._platform_rows().select(
            F.col("txID").alias("tx_id"),
            F.regexp_replace("txType", "Tx$", "").alias("tx_type"),
            F.col("height").alias("block_number"),
            "block_time",
            F.lit(0).cast("bigint").alias("p_chain_id"),
            F.parse_json("txData").alias("tx_data"),
        )

    def registrations(self) -> DataFrame:
        """Decoded register messages of the RegisterL1Validator orders (number ends in 6)."""
        key, cust = F.col("o_orderkey"), F.col("o_custkey")
        return self.table("orders").where(F.pmod(key, F.lit(10)) == 6).select(
            F.concat(F.lit("tx"), key.cast("string")).alias("tx_id"),
            _subnet(cust).alias("subnet_id"),
            _node(cust, 2).alias("node_id"),
            F.concat(_validation(cust, 2), F.lit("-"), key.cast("string")).alias("validation_id"),
            _cents("o_totalprice").cast("decimal(20,0)").alias("weight"),
            F.concat(F.lit("0xc"), key.cast("string")).alias("bls_public_key"),
            F.array(F.concat(F.lit("P-"), cust.cast("string"))).alias("owner_addresses"),
        )

    def snapshot(self) -> DataFrame:
        """customer: one current validator each; negative account balances have no balance."""
        cust = F.col("c_custkey")
        l1 = F.col("c_mktsegment") != "HOUSEHOLD"
        cents = _cents("c_acctbal")
        return self.spread("customer").select(
            _subnet(cust).alias("subnetID"),
            F.concat(F.lit("stake"), cust.cast("string")).alias("txID"),
            (F.lit(1500000000) + cust * 1000).cast("string").alias("startTime"),
            (F.lit(1800000000) + cust).cast("string").alias("endTime"),
            (F.abs(cents) + 1).cast("string").alias("weight"),
            _node(cust, 1).alias("nodeID"),
            F.when(l1, _validation(cust, 1)).alias("validationID"),
            F.when(l1, F.greatest(cents, F.lit(0)).cast("string")).alias("balance"),
            F.format_string("%d.5", F.pmod(cust, F.lit(100))).alias("uptime"),
            F.lit(True).alias("connected"),
        )

    def registry_entries(self) -> DataFrame:
        """supplier: a registry entry for the subnet of the same number; every tenth has none."""
        key = F.col("s_suppkey")
        return self.table("supplier").select(
            F.when(F.pmod(key, F.lit(10)) != 9, _subnet(key)).otherwise("").alias("subnetId"),
            F.col("s_name").alias("name"),
            F.when(F.pmod(key, F.lit(2)) == 0, F.concat(F.lit("about "), F.col("s_name"))).alias("description"),
            F.concat(F.lit("logo"), key.cast("string")).alias("logo"),
            F.lit("").alias("website"),
        )

    def chain_status(self) -> DataFrame:
        """nation: each nation stands for a chain."""
        key = F.col("n_nationkey").cast("bigint")
        return self.table("nation").select(
            key.alias("chain_id"),
            F.col("n_name").alias("name"),
            F.timestamp_seconds(F.lit(1700000000) - key * key * 30).alias("last_updated"),
            (key * 1000 + 500).alias("last_block_on_chain"),
        )

    def sync_watermarks(self) -> DataFrame:
        """Two thirds of the chains have a sync watermark."""
        key = F.col("n_nationkey").cast("bigint")
        return self.table("nation").where(F.pmod(key, F.lit(3)) != 2).select(
            key.alias("chain_id"), (key * 1000 + 500 - key * key * 3).alias("block_number")
        )

    # --- nested block records -------------------------------------------------------

    def _numbered_lines(self) -> DataFrame:
        """Line items with their place among those of the same numbers, kept as a table: each reader of it would sort them anew."""
        same = Window.partitionBy("l_orderkey", "l_linenumber").orderBy("l_linestatus", "l_partkey", "l_suppkey", "l_extendedprice")
        path = scratch(self.spark)
        self.table("lineitem").withColumn("copy", F.row_number().over(same)).write.parquet(path)
        return self.spark.read.parquet(path)

    def nested_blocks(self, unique: bool = False) -> DataFrame:
        """lineitem: every row is a block of its own with two transactions, receipts with logs, and one call tree.

        Line items with the same numbers have the same hashes, unless these are to be ``unique``.
        """
        key = F.col("l_orderkey") * 8 + F.col("l_linenumber")
        part, supp = F.col("l_partkey"), F.col("l_suppkey")
        hx = lambda c: F.concat(F.lit("0x"), F.lower(F.hex(c.cast("bigint"))))
        h32 = lambda c: text_of(c, 32)
        a20 = lambda c: text_of(c, 20)
        items, number = (self._numbered_lines(), key * 1000 + F.col("copy")) if unique else (self.spread("lineitem"), key)
        c = F.col
        taxed = c("l_tax") != 0
        numbers = items.select(
            "*", key.alias("key"), number.alias("number"), _cents("l_extendedprice").alias("cents"),
            _seconds(_spread("l_shipdate", F.col("l_orderkey") * 7919)).alias("seconds"),
        )
        # text forms of the row's numbers, computed once: records of plain columns are not made where only some of their fields are read
        rows = numbers.select(
            *[a20(part + i).alias(f"part{i}") for i in (0, 1)],
            *[a20(supp + i).alias(f"supp{i}") for i in (0, 1)],
            *[h32(c("number") * 2 + i).alias(f"hash{i}") for i in (0, 1)],
            *[hx(c("l_linenumber") + i).alias(f"nonce{i}") for i in (0, 1)],
            *[hx(c("cents") * (i + 1)).alias(f"value{i}") for i in (0, 1)],
            h32(part).alias("part32"),
            h32(c("key")).alias("key32"),
            h32(F.greatest(c("key") - 1, F.lit(0))).alias("parent32"),
            h32(c("l_orderkey")).alias("order32"),
            h32(c("cents")).alias("cents32"),
            hx(c("key")).alias("height"),
            hx(c("seconds")).alias("time"),
            F.when(taxed, hx(c("seconds") * 1000 + F.pmod(part, F.lit(1000)))).alias("millis"),
            hx(F.lit(1000) + part).alias("size"),
            F.when(c("l_quantity") < 10, "0x0").otherwise(hx(c("cents"))).alias("base"),
            hx(c("cents") + 25).alias("price"),
            F.when(taxed, hx(c("cents") * 2)).alias("most"),
            *[F.when(taxed, F.lit(hex(20 + i))).alias(f"tip{i}") for i in (0, 1)],
            hx(F.col("l_quantity").cast("bigint") * 100 + 21000).alias("gas"),
            F.when(F.col("l_linestatus") == "O", "0x1").otherwise("0x0").alias("status"),
            F.when(F.col("l_discount") != 0, a20(supp)).alias("recipient"),
        )

        def tx(i: int) -> Column:
            keys = F.concat(F.lit('[{"address":"'), c("supp0"), F.lit('","storageKeys":["'), c("part32"), F.lit('"]}]'))
            return _record(
                schemas.TX,
                {
                    "hash": c(f"hash{i}"), "transactionIndex": F.lit(hex(i)), "nonce": c(f"nonce{i}"), "from": c(f"part{i}"), "to": c("recipient"),
                    "value": c(f"value{i}"), "gas": F.lit(hex(30000)), "gasPrice": c("price"), "input": F.lit("0xabc"),
                    "type": F.lit("0x2" if i else None), "maxFeePerGas": c("most"), "maxPriorityFeePerGas": c(f"tip{i}"),
                    "accessList": keys if i else F.lit(None),
                },
            )

        def receipt(i: int) -> Column:
            log = _record(
                schemas.LOG,
                {
                    "address": c(f"supp{i}"), "topics": F.array(F.lit("0x" + TRANSFER), c("part32"), c("order32")), "data": c("cents32"),
                    "transactionHash": c(f"hash{i}"), "transactionIndex": F.lit(hex(i)), "logIndex": F.lit(hex(i)), "removed": F.lit(False),
                },
            )
            return _record(schemas.RECEIPT, {"gasUsed": c("gas"), "logs": F.array(log), "status": c("status"), "transactionHash": c(f"hash{i}")})

        calls = F.concat(
            F.lit('{"gas":"0x10","gasUsed":"0x8","input":"0x","type":"call","value":"0x1","from":"'), c("part0"), F.lit('","to":"'), c("supp0"),
            F.lit('","calls":[{"gas":"0x5","gasUsed":"none","input":"0x01","type":"create","from":"'), c("supp0"),
            F.lit('","calls":[{"gas":"0x4","gasUsed":"0x2","input":"0x","type":"staticcall","from":"'), c("supp1"), F.lit('","to":"'), c("part0"),
            F.lit('"}]},{"gas":"0x3","gasUsed":"0x1","input":"0x","type":"","from":"'), c("supp0"), F.lit('","to":"'), c("part0"), F.lit('"}]}'),
        )
        traces = [_record(schemas.TRACE, {"txHash": c(f"hash{i}"), "result": F.lit(None) if i else calls}) for i in (0, 1)]
        block = _record(
            schemas.BLOCK,
            {
                "number": c("height"), "hash": c("key32"), "parentHash": c("parent32"), "timestamp": c("time"), "miner": c("supp0"),
                "difficulty": F.lit("0x1"), "totalDifficulty": c("height"), "size": c("size"), "gasLimit": F.lit(hex(8000000)), "gasUsed": c("gas"),
                "baseFeePerGas": c("base"), "stateRoot": c("part32"), "transactionsRoot": c("supp0"),
                "receiptsRoot": c("part1"), "mixHash": F.lit("0x0"), "nonce": F.lit("0x0"), "sha3Uncles": F.lit("0x1"), "uncles": F.array(c("part32")),
                "minDelayExcess": F.lit("0x7"), "timestampMilliseconds": c("millis"),
                "transactions": F.array(tx(0), tx(1)),
            },
        )
        return rows.select(block.alias("block"), F.array(*traces).alias("traces"), F.array(receipt(0), receipt(1)).alias("receipts"))

    def nested_events(self) -> DataFrame:
        """events: every row is a block with one transaction, one log and a call tree of two calls."""
        kind = F.col("event_type")
        h32 = lambda c: F.concat(F.lit("0x"), F.lower(wide_of(c, 32)))
        a20 = lambda c: F.concat(F.lit("0x"), F.lower(wide_of(c, 20)))
        hx = lambda c: F.concat(F.lit("0x"), F.lower(F.hex(c.cast("bigint"))))
        number, user, ts = F.col("event_id"), F.col("user_id"), F.col("ts").cast("timestamp")
        status = F.when(F.col("value") >= 5, "0x1").otherwise("0x0")
        topic = F.when(kind == "click", "0x" + MESSAGE_SENT).when(kind == "view", "0x" + MESSAGE_RECEIVED).otherwise("0x" + TRANSFER)
        call = F.concat(F.lit('{"type":"CALL","from":"'), a20(user), F.lit('","to":"0x1","calls":[{"type":"'), F.when(kind == "signup", "create2").otherwise("call"), F.lit('","from":"'), a20(user + 1), F.lit('","to":"0x2"}]}'))
        tx = _record(
            schemas.TX,
            {"hash": h32(number), "transactionIndex": F.lit("0x0"), "nonce": F.lit("0x0"), "from": a20(user), "to": F.lit("0x5"), "value": F.lit("0x1"), "gas": F.lit("0x9"), "gasPrice": hx(_cents("value")), "input": F.lit("0x")},
        )
        log = _record(
            schemas.LOG,
            {"address": a20(user), "topics": F.array(topic), "data": F.lit("0x01"), "transactionHash": h32(number), "transactionIndex": F.lit("0x0"), "logIndex": F.lit("0x0")},
        )
        receipt = _record(schemas.RECEIPT, {"gasUsed": F.lit("0x64"), "logs": F.array(log), "status": status, "transactionHash": h32(number)})
        zero = F.lit("0x0")
        block = _record(
            schemas.BLOCK,
            {
                "number": hx(number), "hash": h32(number), "parentHash": zero, "timestamp": hx(F.unix_timestamp(ts)), "timestampMilliseconds": hx(F.unix_millis(ts)), "miner": zero, "size": zero, "gasLimit": zero,
                "gasUsed": F.lit("0x64"), "stateRoot": zero, "transactionsRoot": zero, "receiptsRoot": zero, "mixHash": zero, "nonce": zero, "sha3Uncles": zero, "transactions": F.array(tx),
            },
        )
        trace = _record(schemas.TRACE, {"txHash": h32(number), "result": call})
        return self.spread_by("events", "event_id").select(block.alias("block"), F.array(trace).alias("traces"), F.array(receipt).alias("receipts"))


class StreamStar(Star):
    """The same tables as unbounded streams over their files."""

    def spread(self, name: str) -> DataFrame:
        return self.table(name)

    def spread_by(self, name: str, key: str) -> DataFrame:
        return self.table(name)

    def table(self, name: str) -> DataFrame:
        schema = self.spark.read.parquet(f"{self.folder}/{name}.parquet").schema
        return self.spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(self.folder)


def _record(schema: str, fields: dict[str, Column]) -> Column:
    """A struct of the schema, NULL in the fields not given."""
    kind = _parse_datatype_string(schema)
    return F.struct(*[fields.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in kind.fields])


# The same mappings in DuckDB SQL.  Addresses and hashes are the plain numbers they are made from.
SQL = {
    "raw_txs": """
  SELECT CAST(l_linenumber AS BIGINT) AS chain_id, l_orderkey * 8 + l_linenumber AS hash, l_orderkey AS block_number,
         l_shipdate + to_seconds((l_orderkey * 7919 + l_partkey * 31) % 86400) AS block_time,
         l_linenumber AS transaction_index, l_partkey AS sender, CASE WHEN l_discount <> 0 THEN l_suppkey END AS recipient,
         CAST(round(l_extendedprice * 100) AS HUGEINT) * 18446744073709551616::HUGEINT + l_partkey AS value,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS gas_price, 21000 + CAST(l_quantity AS BIGINT) * 100 AS gas_used,
         l_linestatus = 'O' AS success, CASE WHEN l_discount = 0 THEN l_orderkey END AS contract_address
  FROM lineitem""",
    "raw_blocks": """
  SELECT CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS chain_id, o_orderkey AS block_number,
         o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS block_time, CAST(floor(o_totalprice) AS BIGINT) AS gas_used
  FROM orders""",
    "raw_traces": """
  SELECT user_id % 3 + 1 AS chain_id, event_id AS block_number, ts AS block_time, event_id % 3 AS transaction_index,
         user_id % 3 AS p0, event_id % 5 AS p1, user_id AS sender,
         CASE WHEN event_type <> 'error' THEN CAST(round(value * 100) AS BIGINT) % 1000 END AS recipient,
         CASE event_type WHEN 'click' THEN 'CALL' WHEN 'view' THEN 'STATICCALL' WHEN 'purchase' THEN 'CREATE'
              WHEN 'signup' THEN 'CREATE2' ELSE 'DELEGATECALL' END AS call_type, value >= 5 AS tx_success
  FROM events""",
    "message_logs": """
  SELECT user_id % 3 + 1 AS chain_id, event_id AS block_number, ts AS block_time, user_id AS address, event_id AS transaction_hash,
         event_id % 4 AS log_index, CASE event_type WHEN 'click' THEN 'sent' WHEN 'view' THEN 'received' ELSE 'other' END AS topic0,
         event_type = 'purchase' AS coin, CAST(round(value * 100) AS BIGINT) * 10000 AS amount
  FROM events""",
    "token_logs": """
  SELECT CAST(l_linenumber AS BIGINT) AS chain_id, l_orderkey AS block_number,
         l_shipdate + to_seconds((l_orderkey * 7919 + l_partkey * 31) % 86400) AS block_time,
         l_suppkey + 1 AS token, l_partkey AS w1, l_orderkey AS w2, l_returnflag AS kind, l_tax <> 0 AS whole,
         CAST(round(l_extendedprice * 100) AS HUGEINT) * 18446744073709551616::HUGEINT + l_partkey AS amount
  FROM lineitem""",
    "platform_txs": """
  SELECT 'tx' || o_orderkey AS tx_id, o_orderkey AS block_number, o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS block_time,
         o_orderkey % 10 AS kind, o_custkey AS cust, 'subnet' || o_custkey AS subnet_id,
         CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
         ['CreateChain','ConvertSubnetToL1','IncreaseL1ValidatorBalance','DisableL1Validator','AddSubnetValidator',
          'TransformSubnet','RegisterL1Validator','AdvanceTime','Import','Export'][o_orderkey % 10 + 1] AS tx_type
  FROM orders""",
}


def with_tables(*names: str) -> str:
    """A WITH clause that defines the named mappings."""
    return "WITH " + ",\n".join(f"{n} AS ({SQL[n]})" for n in names)
