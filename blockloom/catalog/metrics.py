"""Metrics, cumulative metrics and the period helpers."""

from __future__ import annotations

from pyspark.sql import functions as F

from blockloom.catalog import period_sql, plain, query, text_time
from blockloom.constants import GRANULARITIES
from blockloom.functions import periods as P
from blockloom.plans import metrics as M
from blockloom.sources.star_schema import Star, with_tables

SECOND = "date_trunc('second', ts)"
MADE = "call_type IN ('CREATE','CREATE2','CREATE3') AND tx_success"
ENDS = "(SELECT chain_id, block_time, sender AS a, call_type, tx_success FROM raw_traces UNION ALL SELECT chain_id, block_time, recipient, call_type, tx_success FROM raw_traces)"


def _tables(star: Star) -> dict:
    return {"raw_txs": star.raw_txs(), "raw_blocks": star.raw_blocks(), "raw_traces": star.raw_traces(), "raw_logs": star.message_logs()}


def _seconds(g: str) -> str:
    return f"epoch(p + INTERVAL 1 {g.upper()}) - epoch(p)"


def series_sql(name: str, table: str, select, grains=GRANULARITIES, source: str | None = None) -> str:
    """The four granularities of a metric; ``select(p, g)`` gives the SELECT that yields chain_id, p, v."""
    parts = [
        f"SELECT chain_id, '{name}' AS metric_name, '{g}' AS granularity, {text_time('p')} AS period, CAST(v AS VARCHAR) AS value"
        f" FROM ({select(period_sql('block_time', g), g)})"
        for g in grains
    ]
    return with_tables(table) + "\n" + "\nUNION ALL\n".join(parts)


def _grouped(table: str, value: str, where: str = "TRUE"):
    return lambda p, g: f"SELECT chain_id, {p} AS p, {value} AS v FROM {table} WHERE {where} GROUP BY 1, 2"


def _rate(table: str, value: str):
    return lambda p, g: (
        f"SELECT chain_id, p, CAST(floor(n / ({_seconds(g)})) AS BIGINT) AS v FROM (SELECT chain_id, {p} AS p, {value} AS n FROM {table} GROUP BY 1, 2)"
    )


def _peak(table: str, value: str):
    return lambda p, g: (
        f"SELECT chain_id, p, max(n) AS v FROM (SELECT chain_id, {p} AS p, date_trunc('second', block_time) AS s, {value} AS n FROM {table} GROUP BY 1, 2, 3) GROUP BY 1, 2"
    )


def _running(table: str, where: str = "TRUE"):
    return lambda p, g: (
        f"SELECT chain_id, p, CAST(sum(n) OVER (PARTITION BY chain_id ORDER BY p) AS BIGINT) AS v FROM (SELECT chain_id, {p} AS p, count(*) AS n FROM {table} WHERE {where} GROUP BY 1, 2)"
    )


def _running_new(rows: str):
    def select(p: str, g: str) -> str:
        first = f"SELECT chain_id, a, min(block_time) AS block_time FROM {rows} GROUP BY 1, 2"
        return f"SELECT chain_id, p, CAST(sum(n) OVER (PARTITION BY chain_id ORDER BY p) AS BIGINT) AS v FROM (SELECT chain_id, {p} AS p, count(*) AS n FROM ({first}) GROUP BY 1, 2)"

    return select


_DEPLOYED = f"(SELECT chain_id, block_time, sender AS a FROM raw_traces WHERE {MADE} AND sender <> 0)"
_SEEN = f"(SELECT chain_id, block_time, a FROM {ENDS} WHERE a IS NOT NULL AND a <> 0)"

METRIC_SQL = {
    "tx_count": ("M1 F1 P1 A6", "raw_txs", _grouped("raw_txs", "count(*)")),
    "gas_used": ("M2", "raw_txs", _grouped("raw_txs", "CAST(sum(gas_used) AS BIGINT)")),
    "fees_paid": ("M3 X18", "raw_txs", _grouped("raw_txs", "sum(CAST(gas_used AS HUGEINT) * gas_price)")),
    "avg_gas_price": ("M4", "raw_txs", _grouped("raw_txs", "CAST(sum(gas_price) // count(*) AS BIGINT)")),
    "max_gas_price": ("M5", "raw_txs", _grouped("raw_txs", "max(gas_price)")),
    "avg_tps": ("M6 X11", "raw_txs", _rate("raw_txs", "count(*)")),
    "avg_gps": ("M7", "raw_blocks", _rate("raw_blocks", "sum(gas_used)")),
    "max_tps": ("M8 P5 A8", "raw_txs", _peak("raw_txs", "count(*)")),
    "max_gps": ("M9", "raw_blocks", _peak("raw_blocks", "CAST(sum(gas_used) AS BIGINT)")),
    "active_addresses": (
        "M10 A3 F5 U1",
        "raw_traces",
        lambda p, g: f"SELECT chain_id, {p} AS p, count(DISTINCT a) AS v FROM {ENDS} WHERE a IS NOT NULL AND a <> 0 GROUP BY 1, 2",
    ),
    "active_senders": ("M11", "raw_traces", _grouped("raw_traces", "count(DISTINCT sender)", "sender <> 0")),
    "contracts": ("M12 F6", "raw_traces", _grouped("raw_traces", "count(*)", MADE)),
    "deployers": ("M13", "raw_traces", _grouped("raw_traces", "count(DISTINCT sender)", f"{MADE} AND sender <> 0")),
    "icm_sent": ("M14 F4 X6", "message_logs", _grouped("message_logs", "count(*)", "topic0 = 'sent'")),
    "icm_received": ("M15", "message_logs", _grouped("message_logs", "count(*)", "topic0 = 'received'")),
    "icm_total": ("M16", "message_logs", _grouped("message_logs", "count(*)", "topic0 IN ('sent', 'received')")),
    "usdc_volume": ("M17 X5", "message_logs", _grouped("message_logs", "CAST(sum(amount) // 1000000 AS BIGINT)", "coin")),
    "cumulative_tx_count": ("M18 W1", "raw_txs", _running("raw_txs")),
    "cumulative_contracts": ("M19", "raw_traces", _running("raw_traces", MADE)),
    "cumulative_addresses": ("M20", "raw_traces", _running_new(_SEEN)),
    "cumulative_deployers": ("M21", "raw_traces", _running_new(_DEPLOYED)),
}


def _register(name: str, ids: str, table: str, select) -> None:
    @query(f"metric_{name}", ids, series_sql(name, table, select))
    def run(star: Star):
        return plain(M.metric_batch(_tables(star), [name]))


for _name, (_ids, _table, _select) in METRIC_SQL.items():
    _register(_name, _ids, _table, _select)


# one metric at one granularity and in a time range, computed on its own

_RANGE = ("1997-02-02 00:00:00", "1999-03-07 00:00:00")


@query(
    "metric_range_gas_used_week",
    "M2 F2",
    with_tables("raw_txs")
    + f"""
SELECT chain_id, 'gas_used' AS metric_name, 'week' AS granularity, {text_time(period_sql('block_time', 'week'))} AS period,
       CAST(CAST(sum(gas_used) AS BIGINT) AS VARCHAR) AS value
FROM raw_txs WHERE block_time >= TIMESTAMP '{_RANGE[0]}' AND block_time < TIMESTAMP '{_RANGE[1]}' GROUP BY 1, 4""",
)
def metric_range_gas_used_week(star: Star):
    first, last = [F.lit(t).cast("timestamp") for t in _RANGE]
    return plain(M.metric("gas_used", "week", _tables(star), None, first, last))


@query(
    "cumulative_range_addresses",
    "M20 F2 J10",
    with_tables("raw_traces")
    + f"""
, firsts AS (SELECT chain_id, a, min(block_time) AS t FROM {ENDS} WHERE a IS NOT NULL AND a <> 0 AND block_time < TIMESTAMP '2024-01-21' GROUP BY 1, 2)
, news AS (SELECT chain_id, date_trunc('day', t) AS p, count(*) AS n, max(t) AS latest FROM firsts GROUP BY 1, 2)
, total AS (SELECT chain_id, p, latest, sum(n) OVER (PARTITION BY chain_id ORDER BY p) AS v FROM news)
SELECT chain_id, 'cumulative_addresses' AS metric_name, 'day' AS granularity, {text_time('p')} AS period, CAST(CAST(v AS BIGINT) AS VARCHAR) AS value
FROM total WHERE latest >= TIMESTAMP '2024-01-05'""",
)
def cumulative_range_addresses(star: Star):
    first, last = F.lit("2024-01-05").cast("timestamp"), F.lit("2024-01-21").cast("timestamp")
    return plain(M.metric("cumulative_addresses", "day", _tables(star), None, first, last))


@query(
    "cumulative_from_stored_metric",
    "M22 W2 J10",
    with_tables("raw_txs")
    + f"""
, m AS (SELECT chain_id, date_trunc('month', block_time) AS p, count(*) AS n FROM raw_txs GROUP BY 1, 2)
, c AS (SELECT chain_id, p, sum(n) OVER (PARTITION BY chain_id ORDER BY p) AS v FROM m)
SELECT chain_id, 'cumulative_tx_count' AS metric_name, 'month' AS granularity, {text_time('p')} AS period, CAST(CAST(v AS BIGINT) AS VARCHAR) AS value
FROM c WHERE p >= TIMESTAMP '1998-01-01'""",
)
def cumulative_from_stored_metric(star: Star):
    stored = M.metric_batch({"raw_txs": star.raw_txs()}, ["tx_count", "cumulative_tx_count"], grains=("month",))
    first = F.lit("1998-01-01").cast("timestamp")
    return plain(M.cumulative_from_metric(stored, "tx_count", "month", first))


@query(
    "token_volume_by_week",
    "M17 X5 X9 F7 A6",
    with_tables("token_logs")
    + f"""
SELECT chain_id, token AS address, {text_time(period_sql('block_time', 'week'))} AS period, CAST(sum(amount) // 1000000 AS VARCHAR) AS value
FROM token_logs WHERE kind = 'A' AND whole GROUP BY 1, 2, 3""",
)
def token_volume_by_week(star: Star):
    return plain(M.token_volume(star.token_logs(), None, 6, "week"))


@query(
    "token_volume_one_token",
    "M17 X5 F4",
    with_tables("token_logs")
    + "\n"
    + "\nUNION ALL\n".join(
        f"SELECT chain_id, 'token_7' AS metric_name, '{g}' AS granularity, {text_time(period_sql('block_time', g))} AS period, CAST(sum(amount) // 1000000 AS VARCHAR) AS value FROM token_logs WHERE token = 7 AND kind = 'A' AND whole GROUP BY 1, 4"
        for g in GRANULARITIES
    ),
)
def token_volume_one_token(star: Star):
    spec = M.MetricSpec("token_7", "raw_logs", "token_volume", token=f"{7:040x}", decimals=6)
    return plain(M.token_volume_batch(star.token_logs(), spec, GRANULARITIES))


@query(
    "active_addresses_estimate",
    "M10 A2",
)
def active_addresses_estimate(star: Star):
    return plain(M.metric_batch(_tables(star), ["active_addresses", "active_senders", "deployers"], approx=True))


# --- period helpers ---------------------------------------------------------------------------


@query(
    "period_boundaries",
    "P1 P2 P5 X10 X11 X12",
    "SELECT event_id, "
    + ", ".join(f"{text_time(period_sql('ts', g))} AS {g}_start" for g in GRANULARITIES)
    + ", "
    + ", ".join(f"{text_time(period_sql('ts', g) + f' + INTERVAL 1 {g.upper()}')} AS {g}_next" for g in GRANULARITIES)
    + f", {text_time(SECOND)} AS second, CAST(floor(epoch(ts)) AS BIGINT) AS unix,"
    " CAST(epoch(date_trunc('month', ts) + INTERVAL 1 MONTH) - epoch(date_trunc('month', ts)) AS BIGINT) AS month_seconds FROM events",
)
def period_boundaries(star: Star):
    ts = F.col("ts").cast("timestamp")
    return plain(
        star.table("events").select(
            "event_id",
            *[P.period_start(ts, g).alias(f"{g}_start") for g in GRANULARITIES],
            *[P.next_period(ts, g).alias(f"{g}_next") for g in GRANULARITIES],
            P.second_bucket(ts).alias("second"),
            P.epoch_seconds(ts).alias("unix"),
            P.period_seconds(P.period_start(ts, "month"), "month").alias("month_seconds"),
        )
    )


@query(
    "complete_periods",
    "P3",
    with_tables("raw_txs")
    + """
, latest AS (SELECT chain_id, max(block_time) AS t FROM raw_txs GROUP BY 1)
, p AS (SELECT DISTINCT chain_id, date_trunc('month', block_time) AS period FROM raw_txs)
SELECT p.chain_id, strftime(p.period, '%Y-%m-%d %H:%M:%S') AS period, latest.t >= p.period + INTERVAL 1 MONTH AS complete
FROM p JOIN latest ON p.chain_id = latest.chain_id""",
)
def complete_periods(star: Star):
    counts = star.raw_txs().groupBy("chain_id", P.period_start("block_time", "month").alias("period")).agg(F.max("block_time").alias("latest"))
    latest = counts.groupBy("chain_id").agg(F.max("latest").alias("t"))
    joined = counts.join(latest, "chain_id")
    return plain(joined.select("chain_id", "period", P.is_complete("period", "t", "month").alias("complete")))


@query(
    "pending_periods_after_watermark",
    "P4 V5",
    """
WITH s AS (SELECT user_id % 3 + 1 AS chain_id, min(ts) AS lo, max(ts) AS hi FROM events GROUP BY 1)
SELECT chain_id, strftime(u.period, '%Y-%m-%d %H:%M:%S') AS period
FROM (SELECT chain_id, unnest(generate_series(date_trunc('day', lo) + INTERVAL 1 DAY, date_trunc('day', hi) - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS period FROM s) u""",
)
def pending_periods_after_watermark(star: Star):
    state = star.raw_traces().groupBy("chain_id").agg(F.min("block_time").alias("last_period"), F.max("block_time").alias("latest"))
    return plain(P.pending_periods(state, "day").select("chain_id", "period"))


@query(
    "fill_missing_days",
    "P6",
    with_tables("raw_blocks")
    + """
, d AS (SELECT chain_id, date_trunc('day', block_time) AS p, count(*) AS n FROM raw_blocks GROUP BY 1, 2)
, c AS (SELECT DISTINCT chain_id FROM raw_blocks)
, spine AS (SELECT chain_id, unnest(generate_series(TIMESTAMP '1996-12-25', TIMESTAMP '1997-06-29', INTERVAL 1 DAY)) AS p FROM c)
SELECT spine.chain_id, strftime(spine.p, '%Y-%m-%d %H:%M:%S') AS period, coalesce(n, 0) AS value
FROM spine LEFT JOIN d ON spine.chain_id = d.chain_id AND spine.p = d.p""",
)
def fill_missing_days(star: Star):
    days = star.raw_blocks().groupBy("chain_id", P.period_start("block_time", "day").alias("period")).agg(F.count("*").alias("value"))
    start, end = F.lit("1996-12-25").cast("timestamp"), F.lit("1997-06-30").cast("timestamp")
    return plain(M.fill_periods(days, start, end, "day", ["chain_id"]))


_AS_OF = "2024-01-31 12:30:00"
_PRESETS = {"24h": ("24 HOUR", "hour"), "7d": ("7 DAY", "hour"), "30d": ("30 DAY", "day"), "90d": ("90 DAY", "day"), "1y": ("1 YEAR", "day")}


def _preset_sql(preset: str) -> str:
    back, g = _PRESETS[preset]
    start = f"date_trunc('{g}', TIMESTAMP '{_AS_OF}' - INTERVAL {back})"
    end = f"date_trunc('{g}', TIMESTAMP '{_AS_OF}')"
    return f"""
SELECT spine.chain_id, '{preset}' AS preset, 'contracts' AS metric_name, '{g}' AS granularity, strftime(spine.p, '%Y-%m-%d %H:%M:%S') AS period, CAST(coalesce(n, 0) AS VARCHAR) AS value
FROM (SELECT DISTINCT chain_id, unnest(generate_series({start}, {end}, INTERVAL 1 {g.upper()})) AS p FROM (SELECT chain_id FROM raw_traces WHERE {MADE} AND date_trunc('{g}', block_time) BETWEEN {start} AND {end})) spine
LEFT JOIN (SELECT chain_id, date_trunc('{g}', block_time) AS p, count(*) AS n FROM raw_traces WHERE {MADE} GROUP BY 1, 2) d ON spine.chain_id = d.chain_id AND spine.p = d.p"""


@query("metric_series_presets", "Q-4 P6 P7 V1", with_tables("raw_traces") + "\n" + "\nUNION ALL\n".join(_preset_sql(p) for p in _PRESETS))
def metric_series_presets(star: Star):
    stored = M.metric_batch({"raw_traces": star.raw_traces()}, ["contracts"], grains=("hour", "day"))
    stale = stored.withColumn("value", F.col("value") + 1).withColumn("computed_at", F.timestamp_seconds(F.lit(1)))
    versions = stored.withColumn("computed_at", F.timestamp_seconds(F.lit(2))).unionByName(stale)
    out = None
    for preset in _PRESETS:
        part = M.metric_series(versions, None, "contracts", preset, _AS_OF).withColumn("preset", F.lit(preset))
        out = part if out is None else out.unionByName(part)
    return plain(out)


@query(
    "metric_name_list",
    "Q-3 A7",
    with_tables("raw_traces")
    + f"""
SELECT DISTINCT 'active_senders' AS metric_name FROM raw_traces WHERE sender <> 0
UNION SELECT 'contracts' FROM raw_traces WHERE {MADE}""",
)
def metric_name_list(star: Star):
    stored = M.metric_batch({"raw_traces": star.raw_traces()}, ["active_senders", "contracts"], grains=("day",))
    return M.metric_names(stored, None, "day")
