"""Filters, aggregations, windows, joins, sorting, set operations, versioned tables, data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from blockloom.catalog import plain, query
from blockloom.constants import DEPOSIT, MESSAGE_RECEIVED, MESSAGE_SENT, TRANSFER
from blockloom.functions.hexes import topic_address
from blockloom.functions.periods import period_start, second_bucket
from blockloom.operators import aggregates as A
from blockloom.operators import filters as FI
from blockloom.operators import joins as J
from blockloom.operators import quality as D
from blockloom.operators import sets as U
from blockloom.operators import sorting as K
from blockloom.operators import versioned as V
from blockloom.operators import windows as W
from blockloom.plans.balances import address_on_chain
from blockloom.sources.star_schema import Star, with_tables

TS = "strftime({}, '%Y-%m-%d %H:%M:%S')".format

# --- filters -----------------------------------------------------------------------------


@query("filter_chain_time_block", "F1 F2 F3", with_tables("raw_txs") + """
SELECT block_number, sender AS "from", gas_used FROM raw_txs
WHERE chain_id = 3 AND block_time >= TIMESTAMP '1996-01-01' AND block_time < TIMESTAMP '1999-01-01' AND block_number BETWEEN 10 AND 100000""")  # fmt: skip
def filter_chain_time_block(star: Star):
    df = FI.for_chain(star.raw_txs(), 3)
    df = FI.in_time_range(df, "block_time", F.lit("1996-01-01").cast("timestamp"), F.lit("1999-01-01").cast("timestamp"))
    return plain(FI.in_block_range(df, 10, 100000).select("block_number", "from", "gas_used"))


@query("filter_signatures", "F4 X6", with_tables("message_logs") + """
SELECT block_number, log_index, topic0 = 'sent' AS sent FROM message_logs WHERE topic0 IN ('sent', 'received')""")  # fmt: skip
def filter_signatures(star: Star):
    rows = FI.with_signature(star.message_logs(), [MESSAGE_SENT, MESSAGE_RECEIVED])
    return plain(rows.select("block_number", "log_index", FI.bytes_in("topic0", [MESSAGE_SENT]).alias("sent")))


@query("filter_zero_address", "F5", with_tables("raw_traces") + """
SELECT block_number, sender AS "from", recipient AS "to" FROM raw_traces WHERE sender <> 0 AND recipient IS NOT NULL AND recipient <> 0""")  # fmt: skip
def filter_zero_address(star: Star):
    return plain(FI.non_zero(FI.non_zero(star.raw_traces(), "from"), "to").select("block_number", "from", "to"))


@query("filter_creates", "F6", with_tables("raw_traces") + """
SELECT block_number, call_type FROM raw_traces WHERE call_type IN ('CREATE', 'CREATE2', 'CREATE3') AND tx_success""")  # fmt: skip
def filter_creates(star: Star):
    return FI.creates(star.raw_traces()).select("block_number", "call_type")


@query("filter_length", "F7 X8", with_tables("token_logs") + "\nSELECT kind, count(*) AS n FROM token_logs WHERE whole GROUP BY 1")
def filter_length(star: Star):
    rows = FI.has_length(star.token_logs(), "data", 32)
    kind = F.when(FI.bytes_in("topic0", [TRANSFER]), "A").when(FI.bytes_in("topic0", [DEPOSIT]), "N").otherwise("R")
    return rows.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


@query("filter_since", "F8 X12", """
SELECT event_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 7 DAY""")  # fmt: skip
def filter_since(star: Star):
    df = star.table("events").withColumn("ts", F.col("ts").cast("timestamp"))
    return FI.since(df, "ts", "7 DAY", "2024-01-31 00:00:00").select("event_id", "event_type")


@query("filter_having", "F9", """
SELECT l_suppkey AS s, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) >= 600""")  # fmt: skip
def filter_having(star: Star):
    grouped = star.table("lineitem").groupBy(F.col("l_suppkey").alias("s")).agg(F.count("*").alias("n"))
    return FI.having(grouped, F.col("n") >= 600)


@query("filter_search", "F10 X20", """
SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE contains(lower(c_name), '99') OR contains(lower(c_mktsegment), '99')""")  # fmt: skip
def filter_search(star: Star):
    return FI.search(star.table("customer"), ["c_name", "c_mktsegment"], "99").select("c_custkey", "c_name", "c_mktsegment")


@query("filter_one", "F11", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderkey = 777")
def filter_one(star: Star):
    return FI.find_one(star.table("orders"), "o_orderkey", 777).select("o_orderkey", "o_orderpriority")


@query("filter_valid_ids", "F12", """
SELECT regexp_matches(l_returnflag || l_linestatus || l_suppkey, '^[1-9A-HJ-NP-Za-km-z]+$') AS good, count(*) AS n FROM lineitem GROUP BY 1""")  # fmt: skip
def filter_valid_ids(star: Star):
    rows = star.table("lineitem").select(F.concat("l_returnflag", "l_linestatus", F.col("l_suppkey").cast("string")).alias("id"))
    good, bad = FI.valid_ids(rows, ["id"])
    return good.select(F.lit(True).alias("good")).unionByName(bad.select(F.lit(False).alias("good"))).groupBy("good").agg(F.count("*").alias("n"))


# --- aggregations --------------------------------------------------------------------------


@query("agg_conditional", "A1 X15", """
SELECT l_suppkey, CAST(sum(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END) AS BIGINT) AS returned,
       CAST(sum(CASE WHEN l_returnflag = 'Z' THEN l_quantity ELSE 0 END) AS BIGINT) AS none, count(*) FILTER (WHERE l_tax = 0) AS untaxed
FROM lineitem GROUP BY 1""")  # fmt: skip
def agg_conditional(star: Star):
    q = F.col("l_quantity").cast("bigint")
    return star.table("lineitem").groupBy("l_suppkey").agg(
        A.sum_if(q, F.col("l_returnflag") == "A").alias("returned"),
        A.sum_if(q, F.col("l_returnflag") == "Z").alias("none"),
        A.count_if(F.col("l_tax") == 0).alias("untaxed"),
    )


@query("agg_distinct_estimate", "A2")
def agg_distinct_estimate(star: Star):
    return star.table("lineitem").groupBy("l_linenumber").agg(
        A.distinct_count("l_partkey", approx=True).alias("parts"), A.distinct_count("l_partkey", "l_suppkey", approx=True).alias("pairs")
    )


@query("agg_distinct_exact", "A3", "SELECT l_linenumber, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1")
def agg_distinct_exact(star: Star):
    return plain(star.table("lineitem").groupBy("l_linenumber").agg(A.distinct_count("l_partkey").alias("parts")))


@query("agg_distinct_tuple", "A4", "SELECT l_linenumber, count(DISTINCT (l_partkey, l_suppkey)) AS pairs FROM lineitem GROUP BY 1")
def agg_distinct_tuple(star: Star):
    return plain(star.table("lineitem").groupBy("l_linenumber").agg(A.distinct_count("l_partkey", "l_suppkey").alias("pairs")))


@query("agg_any", "A5", "SELECT user_id, arg_max(event_type, event_id) AS last_type FROM events GROUP BY 1")
def agg_any(star: Star):
    return star.table("events").groupBy("user_id").agg(A.any_of("event_type", "event_id").alias("last_type"))


@query("agg_basic", "A6", """
SELECT event_type, min(value) AS lo, max(value) AS hi, avg(value) AS mean, count(*) AS n, sum(event_id)::BIGINT AS ids FROM events GROUP BY 1""")  # fmt: skip
def agg_basic(star: Star):
    v = F.col("value")
    return star.table("events").groupBy("event_type").agg(
        F.min(v).alias("lo"), F.max(v).alias("hi"), F.avg(v).alias("mean"), F.count("*").alias("n"), F.sum("event_id").alias("ids")
    )


@query("agg_select_distinct", "A7", "SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def agg_select_distinct(star: Star):
    return A.distinct(star.table("orders"), ["o_custkey", "o_orderstatus"])


@query("agg_of_agg", "A8", with_tables("raw_txs") + """
SELECT chain_id, max(n) AS peak, CAST(sum(n) AS BIGINT) AS total FROM (SELECT chain_id, date_trunc('second', block_time) AS s, count(*) AS n FROM raw_txs GROUP BY 1, 2) GROUP BY 1""")  # fmt: skip
def agg_of_agg(star: Star):
    return A.agg_of_agg(
        star.raw_txs(), ["chain_id"], [second_bucket("block_time").alias("s")], [F.count("*").alias("n")], [F.max("n").alias("peak"), F.sum("n").alias("total")]
    )


@query("agg_array_key", "A9", with_tables("raw_traces") + "\nSELECT chain_id, p0, p1, count(*) AS n FROM raw_traces GROUP BY 1, 2, 3")
def agg_array_key(star: Star):
    counted = A.count_by(star.raw_traces(), ["chain_id", "trace_address"], "n")
    return plain(counted.select("chain_id", F.col("trace_address")[0].alias("p0"), F.col("trace_address")[1].alias("p1"), "n"))


@query("agg_totals_and_ratio", "A10", """
SELECT CAST(sum(l_quantity) AS BIGINT) AS total_quantity, count(*) AS total_n, sum(l_quantity) / count(*) AS per_row FROM lineitem""")  # fmt: skip
def agg_totals_and_ratio(star: Star):
    rows = star.table("lineitem").select(F.col("l_quantity").cast("bigint").alias("quantity"), F.lit(1).cast("bigint").alias("n"))
    return A.totals(rows, ["quantity", "n"]).withColumn("per_row", A.ratio("total_quantity", "total_n"))


@query("agg_scalars", "A11", """
SELECT (SELECT count(*) FROM orders) AS orders, (SELECT count(DISTINCT o_custkey) FROM orders) AS buyers, (SELECT max(event_id) FROM events) AS last_event""")  # fmt: skip
def agg_scalars(star: Star):
    return A.scalars(
        orders=star.table("orders").agg(F.count("*").alias("n")),
        buyers=star.table("orders").agg(F.count_distinct("o_custkey").alias("n")),
        last_event=star.table("events").agg(F.max("event_id").alias("n")),
    )


@query("agg_period_and_type", "A12", with_tables("raw_traces") + f"""
SELECT call_type, {TS("date_trunc('day', block_time)")} AS period, count(*) AS count FROM raw_traces GROUP BY 1, 2""")  # fmt: skip
def agg_period_and_type(star: Star):
    return plain(A.count_by_period(star.raw_traces(), "day", ["call_type"]))


# --- windows --------------------------------------------------------------------------------


@query("window_running_sum", "W1 W2 W3", """
SELECT user_id, event_id, CAST(sum(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS running FROM events""")  # fmt: skip
def window_running_sum(star: Star):
    df = star.table("events").select("user_id", "event_id")
    return W.running_sum(df, "event_id", "event_id", ["user_id"], width=1000)


@query("window_first_per_key", "W4", """
SELECT o_custkey, o_orderkey, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1""")  # fmt: skip
def window_first_per_key(star: Star):
    rows = star.table("orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    return W.first_per_key(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("window_next_value", "W5", """
SELECT o_custkey, o_orderkey, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS next_value FROM orders""")  # fmt: skip
def window_next_value(star: Star):
    return W.next_value(star.table("orders").select("o_custkey", "o_orderkey"), "o_orderkey", "o_orderkey", ["o_custkey"], width=500)


@query("window_last_known", "W6 N11", """
SELECT o_orderkey, last_value(CASE WHEN o_orderkey % 10 = 7 THEN o_totalprice END IGNORE NULLS) OVER
  (PARTITION BY o_orderstatus ORDER BY o_orderkey RANGE BETWEEN 100 PRECEDING AND CURRENT ROW) AS last_known FROM orders""")  # fmt: skip
def window_last_known(star: Star):
    rows = star.table("orders").select("o_orderstatus", "o_orderkey", F.when(F.pmod("o_orderkey", F.lit(10)) == 7, F.col("o_totalprice")).alias("v"))
    return W.last_known(rows, "v", "o_orderkey", ["o_orderstatus"], 100, width=1000).select("o_orderkey", "last_known")


@query("window_previous_event", "W7", f"""
SELECT o_orderkey, {TS("max(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 SECOND PRECEDING)")} AS previous
FROM orders""")  # fmt: skip
def window_previous_event(star: Star):
    rows = star.table("orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("timestamp").alias("t"))
    return plain(W.previous_event(rows, ["o_custkey"], "t", width=86400 * 200).select("o_orderkey", "previous"))


# --- joins ----------------------------------------------------------------------------------


@query("join_inner", "J1", """
SELECT l_orderkey, l_linenumber, o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")  # fmt: skip
def join_inner(star: Star):
    items = star.table("lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").cast("bigint").alias("l_linenumber"))
    orders = star.table("orders").select(F.col("o_orderkey").alias("k"), "o_custkey")
    return J.join_inner(items, orders, ["k"]).withColumnRenamed("k", "l_orderkey")


@query("join_count_distinct", "J2", """
SELECT count(DISTINCT c_custkey) AS active FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 0 AND n_regionkey IN (1, 3)""")  # fmt: skip
def join_count_distinct(star: Star):
    state = star.table("customer").select(
        F.lit(0).alias("p_chain_id"), F.col("c_nationkey").alias("subnet_id"), "c_custkey", (F.col("c_acctbal") > 0).alias("active")
    )
    subnets = star.table("nation").select(F.lit(0).alias("p_chain_id"), F.col("n_nationkey").alias("subnet_id"), F.col("n_regionkey").cast("string").alias("subnet_type"))
    return J.active_by_type(state, subnets, ["1", "3"], "c_custkey")


@query("join_left_defaults", "J3 X15", """
SELECT c_custkey, coalesce(s_name, '') AS s_name, coalesce(s_acctbal, 0) AS s_acctbal, n_name
FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey LEFT JOIN nation ON c_nationkey = n_nationkey""")  # fmt: skip
def join_left_defaults(star: Star):
    base = star.table("customer").select("c_custkey", F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("n"))
    suppliers = star.table("supplier").select(F.col("s_suppkey").alias("k"), "s_name", "s_acctbal")
    nations = star.table("nation").select(F.col("n_nationkey").alias("n"), "n_name")
    out = J.enrich(base, [(suppliers, ["k"]), (nations, ["n"])], {"s_name": "", "s_acctbal": 0.0})
    return out.select("c_custkey", "s_name", "s_acctbal", "n_name")


@query("join_left_aggregates", "J4", """
SELECT c_custkey, coalesce(n, 0) AS n, coalesce(hi, -1) AS hi FROM customer
LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) a ON c_custkey = a.o_custkey
LEFT JOIN (SELECT o_custkey, max(o_totalprice) AS hi FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) b ON c_custkey = b.o_custkey""")  # fmt: skip
def join_left_aggregates(star: Star):
    orders = star.table("orders").withColumnRenamed("o_custkey", "c_custkey")
    counts = orders.where("o_orderstatus = 'F'").groupBy("c_custkey").agg(F.count("*").alias("n"))
    highs = orders.where("o_orderstatus = 'P'").groupBy("c_custkey").agg(F.max("o_totalprice").alias("hi"))
    return J.enrich_agg(star.table("customer").select("c_custkey"), [counts, highs], ["c_custkey"], {"n": 0, "hi": -1.0})


@query("join_left_first", "J5 W4", """
SELECT c_custkey, o_orderkey FROM customer LEFT JOIN
 (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders) o ON c_custkey = o_custkey AND rn = 1""")  # fmt: skip
def join_left_first(star: Star):
    orders = star.table("orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return J.enrich_first(star.table("customer").select("c_custkey"), orders, ["c_custkey"], ["o_orderkey"])


@query("join_full_outer", "J6", """
SELECT coalesce(s_suppkey, n_nationkey) AS k, coalesce(s_name, n_name) AS name, s_acctbal, n_regionkey
FROM (SELECT * FROM supplier WHERE s_suppkey > 5) FULL OUTER JOIN nation ON s_suppkey = n_nationkey""")  # fmt: skip
def join_full_outer(star: Star):
    a = star.table("supplier").where("s_suppkey > 5").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), "s_acctbal")
    b = star.table("nation").select(F.col("n_nationkey").cast("bigint").alias("k"), F.col("n_name").alias("name"), "n_regionkey")
    return plain(J.merge_full(a, b, ["k"]))


@query("join_not_in", "J7", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def join_not_in(star: Star):
    pending = star.table("orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return J.not_in(star.table("customer").select("c_custkey"), pending, "c_custkey")


@query("join_missing_from", "J8", """
SELECT l_orderkey, l_linenumber FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'F')""")  # fmt: skip
def join_missing_from(star: Star):
    items = star.table("lineitem").select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"))
    kept = star.table("orders").where("o_orderstatus <> 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return J.missing_from(items, kept, ["l_orderkey"])


@query("join_compare", "J9 B11", """
WITH a AS (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1), b AS (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1)
SELECT coalesce(a.k, b.k) AS k, a.n AS n_a, b.n AS n_b, a.n IS NOT DISTINCT FROM b.n AS match FROM a FULL OUTER JOIN b ON a.k = b.k""")  # fmt: skip
def join_compare(star: Star):
    orders = star.table("orders").withColumnRenamed("o_custkey", "k")
    count = lambda df: df.groupBy("k").agg(F.count("*").alias("n"))
    return J.compare(count(orders), count(orders.where("o_orderstatus <> 'P'")), ["k"], ["n"])


@query("join_scalar", "J10", """
SELECT event_type, count(*) AS n, (SELECT count(*) FROM events) AS everything FROM events GROUP BY 1""")  # fmt: skip
def join_scalar(star: Star):
    events = star.table("events")
    return J.with_scalar(events.groupBy("event_type").agg(F.count("*").alias("n")), "everything", events.agg(F.count("*").alias("e")))


@query("join_sum_in_span", "J11", """
WITH s AS (SELECT o_orderkey AS id, o_custkey AS k, o_orderdate - INTERVAL 400 DAY AS a, o_orderdate AS b, o_orderkey % 2 = 0 AS x FROM orders),
     e AS (SELECT o_custkey AS k, o_orderdate AS t, CAST(round(o_totalprice) AS BIGINT) AS amount FROM orders)
SELECT s.id, CAST(coalesce(sum(e.amount), 0) AS VARCHAR) AS total FROM s
LEFT JOIN e ON s.k = e.k AND e.t <= s.b AND (e.t > s.a OR (NOT s.x AND e.t = s.a)) GROUP BY 1""")  # fmt: skip
def join_sum_in_span(star: Star):
    t = F.col("o_orderdate").cast("timestamp")
    orders = star.table("orders")
    spans = orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("k"), (t - F.expr("INTERVAL 400 DAY")).alias("start_time"), t.alias("end_time"),
        (F.pmod("o_orderkey", F.lit(2)) == 0).alias("start_exclusive"),
    )
    events = orders.select(F.col("o_custkey").alias("k"), t.alias("block_time"), F.round("o_totalprice").cast("bigint").alias("amount"))
    return plain(J.sum_in_span(spans, events, "k", "id", width=86400 * 365).select("id", "total"))


@query("join_lookup_chain", "J12", """
SELECT l_partkey AS k, count(*) AS n, min(coalesce(p.p_size, s.s_nationkey, -1)) AS v FROM lineitem
LEFT JOIN (SELECT p_partkey, p_size FROM part WHERE p_size > 25) p ON l_partkey = p_partkey LEFT JOIN supplier s ON l_partkey = s_suppkey GROUP BY 1""")  # fmt: skip
def join_lookup_chain(star: Star):
    keys = star.table("lineitem").groupBy(F.col("l_partkey").alias("k")).agg(F.count("*").alias("n"))
    parts = star.table("part").where("p_size > 25").select(F.col("p_partkey").alias("k"), F.col("p_size").alias("v"))
    suppliers = star.table("supplier").select(F.col("s_suppkey").alias("k"), F.col("s_nationkey").alias("v"))
    return plain(J.lookup_first(keys, [parts, suppliers], "k", "v").withColumn("v", F.coalesce("v", F.lit(-1))))


@query("join_zip_explode", "J13", """
SELECT event_id, pos, CASE WHEN pos < 2 THEN event_id + pos END AS a, user_id * pos AS b FROM events, (VALUES (0), (1), (2)) v(pos)""")  # fmt: skip
def join_zip_explode(star: Star):
    e, u = F.col("event_id"), F.col("user_id")
    rows = star.table("events").select("event_id", F.array(e, e + 1).alias("a"), F.array(u * 0, u, u * 2).alias("b"))
    return plain(J.zip_explode(rows, ["a", "b"]))


# --- sorting --------------------------------------------------------------------------------


@query("sort_by_period", "K1", with_tables("raw_txs") + f"""
SELECT {TS("date_trunc('month', block_time)")} AS period, count(*) AS n FROM raw_txs GROUP BY 1 ORDER BY 1""")  # fmt: skip
def sort_by_period(star: Star):
    counted = star.raw_txs().groupBy(period_start("block_time", "month").alias("period")).agg(F.count("*").alias("n"))
    return plain(K.sort(counted, ["period"]))


@query("sort_top_k", "K2", "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_partkey LIMIT 10")
def sort_top_k(star: Star):
    return K.top_k(star.table("lineitem").groupBy("l_partkey").agg(F.count("*").alias("n")), "n", 10, ["l_partkey"])


@query("sort_latest_k", "K3", f"SELECT event_id, {TS('ts')} AS ts FROM events ORDER BY events.ts DESC, event_id LIMIT 8")
def sort_latest_k(star: Star):
    return plain(K.latest(star.table("events").select("event_id", "ts"), "ts", 8, ["event_id"]))


@query("sort_rank_order", "K4", """
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders ORDER BY CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'O' THEN 1 ELSE 2 END, o_totalprice DESC, o_orderkey""")  # fmt: skip
def sort_rank_order(star: Star):
    rows = star.table("orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return K.rank_order(rows, "o_orderstatus", ["P", "O"], [F.desc("o_totalprice"), F.asc("o_orderkey")])


@query("sort_numeric_text", "K5 X16", """
SELECT c_custkey, coalesce(TRY_CAST(CASE WHEN c_custkey % 3 = 0 THEN 'x' || c_custkey ELSE CAST(c_custkey AS VARCHAR) END AS BIGINT), 0) AS number
FROM customer ORDER BY number DESC, c_custkey""")  # fmt: skip
def sort_numeric_text(star: Star):
    text = F.when(F.pmod("c_custkey", F.lit(3)) == 0, F.concat(F.lit("x"), F.col("c_custkey").cast("string"))).otherwise(F.col("c_custkey").cast("string"))
    rows = star.table("customer").select("c_custkey", text.alias("t"))
    return K.sort_numeric_text(rows, "t", ["c_custkey"]).select("c_custkey", K.numeric_text("t").cast("bigint").alias("number"))


@query("sort_direction_limit", "K6", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 50")
def sort_direction_limit(star: Star):
    return K.sort_limit(star.table("orders").select("o_orderkey", "o_totalprice"), "o_totalprice", "asc", 50, ["o_orderkey"])


@query("sort_merge_lists", "K7", """
SELECT o_orderkey AS k, 'order' AS kind FROM orders UNION ALL SELECT l_orderkey, 'item' FROM lineitem ORDER BY 1, 2""")  # fmt: skip
def sort_merge_lists(star: Star):
    a = star.table("orders").select(F.col("o_orderkey").alias("k"), F.lit("order").alias("kind"))
    return K.merge_sorted(a, star.table("lineitem").select(F.col("l_orderkey").alias("k"), F.lit("item").alias("kind")), "k", ["kind"])


@query("sort_page", "K8 S10", "SELECT o_orderkey FROM orders ORDER BY o_orderkey DESC OFFSET 400 LIMIT 200")
def sort_page(star: Star):
    return K.page(star.table("orders").select("o_orderkey"), [F.desc("o_orderkey")], 2)


@query("sort_page_after_key", "K8", "SELECT o_orderkey FROM orders WHERE o_orderkey > 100 ORDER BY o_orderkey LIMIT 200")
def sort_page_after_key(star: Star):
    return K.page_after(star.table("orders").select("o_orderkey"), "o_orderkey", 100)


# --- set operations --------------------------------------------------------------------------


@query("union_endpoints", "U1", with_tables("raw_txs") + """
SELECT address, count(*) AS n FROM (SELECT sender AS address FROM raw_txs UNION ALL SELECT recipient FROM raw_txs) GROUP BY 1""")  # fmt: skip
def union_endpoints(star: Star):
    return plain(U.union_endpoints(star.raw_txs().select("from", "to"), "from", "to").groupBy("address").agg(F.count("*").alias("n")))


@query("union_missing_columns", "U3", """
SELECT c_custkey AS k, c_name AS name, NULL::DOUBLE AS s_acctbal FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier""")  # fmt: skip
def union_missing_columns(star: Star):
    a = star.table("customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    return U.union_missing(a, star.table("supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), "s_acctbal"))


@query("union_distinct", "U4", "SELECT l_partkey AS k FROM lineitem UNION SELECT l_suppkey FROM lineitem")
def union_distinct(star: Star):
    items = star.table("lineitem")
    return U.union_distinct(items.select(F.col("l_partkey").alias("k")), items.select(F.col("l_suppkey").alias("k")))


@query("union_address_on_chain", "U4 B12", with_tables("raw_traces") + """
SELECT DISTINCT a AS address, chain_id FROM (SELECT sender AS a, chain_id FROM raw_traces UNION ALL SELECT recipient, chain_id FROM raw_traces) WHERE a IS NOT NULL AND a <> 0""")  # fmt: skip
def union_address_on_chain(star: Star):
    return plain(address_on_chain(star.raw_traces()))


# --- versioned tables --------------------------------------------------------------------------


@query("version_latest", "V1", """
SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")  # fmt: skip
def version_latest(star: Star):
    rows = star.table("events").select("user_id", "event_type", "event_id", "value", "ts")
    return V.latest_by_key(rows, ["user_id", "event_type"], "ts", ["event_id"]).drop("ts")


@query("version_upsert", "V1 V2", """
SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'CHANGED' ELSE c_mktsegment END AS segment FROM customer""")  # fmt: skip
def version_upsert(star: Star):
    base = star.table("customer").select("c_custkey", F.col("c_mktsegment").alias("segment"), F.lit(1).alias("version"))
    changed = base.where(F.pmod("c_custkey", F.lit(4)) == 0).withColumn("segment", F.lit("CHANGED")).withColumn("version", F.lit(2))
    return V.latest_by_key(base.unionByName(changed), ["c_custkey"], "version").drop("version")


@query("version_summed", "V3 B4", """
SELECT l_partkey, CAST(sum(l_quantity) AS BIGINT) AS quantity, max(l_orderkey) AS last_order FROM lineitem GROUP BY 1""")  # fmt: skip
def version_summed(star: Star):
    rows = star.table("lineitem").select("l_partkey", F.col("l_quantity").cast("bigint").alias("quantity"), F.col("l_orderkey").alias("last_order"))
    return V.summed(rows, ["l_partkey"], ["quantity"], ["last_order"])


@query("version_since_last", "V8 S9", """
SELECT o_orderkey, o_custkey FROM orders o WHERE o_orderkey > (SELECT max(x.o_orderkey) FROM orders x WHERE x.o_orderdate < TIMESTAMP '1995-01-05')""")  # fmt: skip
def version_since_last(star: Star):
    orders = star.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return V.since_last(orders, orders.where("o_orderdate < timestamp_ntz '1995-01-05 00:00:00'"), "o_orderkey").drop("o_orderdate")


@query("version_since_last_per_key", "V8 S9", """
WITH top AS (SELECT o_custkey, max(o_orderkey) AS t FROM orders WHERE o_orderdate < TIMESTAMP '1996-06-01' GROUP BY 1)
SELECT o.o_orderkey, o.o_custkey FROM orders o LEFT JOIN top ON o.o_custkey = top.o_custkey WHERE t IS NULL OR o.o_orderkey > t""")  # fmt: skip
def version_since_last_per_key(star: Star):
    orders = star.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    done = orders.where("o_orderdate < timestamp_ntz '1996-06-01 00:00:00'")
    return V.since_last(orders, done, "o_orderkey", ["o_custkey"]).select("o_orderkey", "o_custkey")


@query("version_only_new", "S9", """
SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O') GROUP BY 1""")  # fmt: skip
def version_only_new(star: Star):
    stored = star.table("orders").where("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("l_orderkey"))
    return V.only_new(star.table("lineitem").select("l_orderkey"), stored, ["l_orderkey"]).groupBy("l_orderkey").agg(F.count("*").alias("n"))


# --- data quality -------------------------------------------------------------------------------


@query("quality_duplicates_txs", "D1", with_tables("raw_txs") + """
SELECT chain_id, count(*) AS total, count(*) FILTER (WHERE n > 1) AS duplicates FROM (SELECT chain_id, hash, count(*) AS n FROM raw_txs GROUP BY 1, 2) GROUP BY 1""")  # fmt: skip
def quality_duplicates_txs(star: Star):
    return D.duplicate_report(star.raw_txs(), D.RAW_KEYS["raw_txs"], ["chain_id"])


@query("quality_duplicates_blocks", "D1", with_tables("raw_blocks") + """
SELECT chain_id, count(*) AS total, count(*) FILTER (WHERE n > 1) AS duplicates FROM (SELECT chain_id, block_number, count(*) AS n FROM raw_blocks GROUP BY 1, 2) GROUP BY 1""")  # fmt: skip
def quality_duplicates_blocks(star: Star):
    return D.duplicate_report(star.raw_blocks(), D.RAW_KEYS["raw_blocks"], ["chain_id"])


@query("quality_duplicates_traces", "D1 A9", with_tables("raw_traces") + """
SELECT chain_id, count(*) AS total, count(*) FILTER (WHERE n > 1) AS duplicates
FROM (SELECT chain_id, transaction_index, p0, p1, count(*) AS n FROM raw_traces GROUP BY 1, 2, 3, 4) GROUP BY 1""")  # fmt: skip
def quality_duplicates_traces(star: Star):
    return D.duplicate_report(star.raw_traces(), ["chain_id", "transaction_index", "trace_address"], ["chain_id"])


@query("quality_duplicates_logs", "D1", with_tables("token_logs") + """
SELECT chain_id, count(*) AS total, count(*) FILTER (WHERE n > 1) AS duplicates FROM (SELECT chain_id, block_number, count(*) AS n FROM token_logs GROUP BY 1, 2) GROUP BY 1""")  # fmt: skip
def quality_duplicates_logs(star: Star):
    return D.duplicate_report(star.token_logs(), D.RAW_KEYS["raw_logs"], ["chain_id"])


_RUNS = with_tables("raw_blocks") + """
, g AS (SELECT chain_id, block_number, block_number - row_number() OVER (PARTITION BY chain_id ORDER BY block_number) AS run FROM (SELECT DISTINCT chain_id, block_number FROM raw_blocks))
"""  # fmt: skip


@query("quality_block_ranges", "D2", _RUNS + "SELECT chain_id, min(block_number) AS range_start, max(block_number) AS range_end FROM g GROUP BY chain_id, run")
def quality_block_ranges(star: Star):
    return D.ranges(star.raw_blocks(), "block_number", ["chain_id"], width=100)


@query("quality_missing_blocks", "D3", with_tables("raw_blocks") + """
SELECT b.chain_id, b.block_number FROM (SELECT chain_id, unnest(generate_series(min(block_number), max(block_number))) AS block_number FROM raw_blocks GROUP BY 1) b
LEFT JOIN (SELECT DISTINCT chain_id, block_number FROM raw_blocks) r ON b.chain_id = r.chain_id AND b.block_number = r.block_number WHERE r.chain_id IS NULL""")  # fmt: skip
def quality_missing_blocks(star: Star):
    return D.missing_blocks(star.raw_blocks(), "block_number", ["chain_id"], width=100)


@query("sort_page_after_ties", "K8", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE (l_orderkey, l_linenumber) > (100, 2) ORDER BY 1, 2 LIMIT 200")
def sort_page_after_ties(star: Star):
    return K.page_after(star.table("lineitem").select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"], (100, 2))


@query("quality_missing_in_range", "D3", """
SELECT k.block_number FROM (SELECT unnest(generate_series(100, 5000)) AS block_number) k
LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem) x ON x.l_orderkey = k.block_number WHERE l_orderkey IS NULL""")  # fmt: skip
def quality_missing_in_range(star: Star):
    return D.missing_in_range(star.table("lineitem").select(F.col("l_orderkey").alias("block_number")), 100, 5000)


@query("quality_max_block", "D5", with_tables("raw_blocks") + "\nSELECT chain_id, max(block_number) AS max_block FROM raw_blocks GROUP BY 1")
def quality_max_block(star: Star):
    return D.max_block(star.raw_blocks(), ["chain_id"])


@query("topic_addresses", "X7 X8", with_tables("token_logs") + "\nSELECT token, w1 AS wallet, count(*) AS n FROM token_logs GROUP BY 1, 2")
def topic_addresses(star: Star):
    rows = star.token_logs().select(F.col("address").alias("token"), topic_address("topic1").alias("wallet"))
    return plain(rows.groupBy("token", "wallet").agg(F.count("*").alias("n")))
