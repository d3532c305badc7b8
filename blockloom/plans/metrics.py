"""Time-bucketed and cumulative metrics in the long format
(chain_id, metric_name, granularity, period, value).

A metric is declared once as a ``MetricSpec``.  ``metric`` computes one of them for one
granularity; ``metric_batch`` computes many for all granularities with one scan per source
table, rolling hours up to days, weeks and months where the metric is additive.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockloom.constants import (
    CREATE_CALLS,
    GRANULARITIES,
    MESSAGE_RECEIVED,
    MESSAGE_SENT,
    TRANSFER,
    USDC_ADDRESS,
    USDC_DECIMALS,
)
from blockloom.functions.hexes import byte_length, non_zero
from blockloom.functions.periods import interval, next_period, period_seconds, period_start, range_preset, second_bucket
from blockloom.functions.text import trunc_div
from blockloom.functions.u256 import LIMBS, limb_sums, quotient_text, u256_limbs
from blockloom.operators.filters import bytes_in, for_chain, in_time_range
from blockloom.operators.versioned import latest_by_key
from blockloom.operators.windows import running_sum

VALUE = "decimal(38,0)"
SERIES = ["chain_id", "metric_name", "granularity", "period", "value"]


@dataclass(frozen=True)
class MetricSpec:
    """kind is one of count, sum, max, avg, rate, peak, distinct, token_volume, cumulative, cumulative_distinct.

    ``measure`` is the summed column of sum, max, avg, rate and peak (rows are counted if it
    is None); ``keys`` are the columns whose values a distinct kind counts together.
    """

    name: str
    source: str
    kind: str
    measure: Callable[[], Column] | None = None
    where: Callable[[], Column] | None = None
    keys: tuple[str, ...] = ()
    token: str = ""
    decimals: int = 0
    narrow: bool = False  # 32-bit measure: bigint sums are safe and stay in generated code


def _created() -> Column:
    return F.col("call_type").isin(*CREATE_CALLS) & F.col("tx_success")


def _fee() -> Column:
    return F.col("gas_used").cast("decimal(20,0)") * F.col("gas_price").cast("decimal(20,0)")


SPECS: dict[str, MetricSpec] = {}


def register(spec: MetricSpec) -> MetricSpec:
    """Add a metric; this is the extension point for new ones."""
    SPECS[spec.name] = spec
    return spec


for _spec in (
    MetricSpec("tx_count", "raw_txs", "count"),
    MetricSpec("gas_used", "raw_txs", "sum", lambda: F.col("gas_used"), narrow=True),
    MetricSpec("fees_paid", "raw_txs", "sum", _fee),
    MetricSpec("avg_gas_price", "raw_txs", "avg", lambda: F.col("gas_price")),
    MetricSpec("max_gas_price", "raw_txs", "max", lambda: F.col("gas_price")),
    MetricSpec("avg_tps", "raw_txs", "rate"),
    MetricSpec("avg_gps", "raw_blocks", "rate", lambda: F.col("gas_used"), narrow=True),
    MetricSpec("max_tps", "raw_txs", "peak"),
    MetricSpec("max_gps", "raw_blocks", "peak", lambda: F.col("gas_used"), narrow=True),
    MetricSpec("active_addresses", "raw_traces", "distinct", keys=("from", "to")),
    MetricSpec("active_senders", "raw_traces", "distinct", keys=("from",)),
    MetricSpec("contracts", "raw_traces", "count", where=_created),
    MetricSpec("deployers", "raw_traces", "distinct", where=_created, keys=("from",)),
    MetricSpec("icm_sent", "raw_logs", "count", where=lambda: bytes_in("topic0", [MESSAGE_SENT])),
    MetricSpec("icm_received", "raw_logs", "count", where=lambda: bytes_in("topic0", [MESSAGE_RECEIVED])),
    MetricSpec("icm_total", "raw_logs", "count", where=lambda: bytes_in("topic0", [MESSAGE_SENT, MESSAGE_RECEIVED])),
    MetricSpec("usdc_volume", "raw_logs", "token_volume", token=USDC_ADDRESS, decimals=USDC_DECIMALS),
    MetricSpec("cumulative_tx_count", "raw_txs", "cumulative"),
    MetricSpec("cumulative_contracts", "raw_traces", "cumulative", where=_created),
    MetricSpec("cumulative_addresses", "raw_traces", "cumulative_distinct", keys=("from", "to")),
    MetricSpec("cumulative_deployers", "raw_traces", "cumulative_distinct", where=_created, keys=("from",)),
):
    register(_spec)


def _named(df: DataFrame, name: str, granularity: str, value: Column) -> DataFrame:
    return df.select(
        "chain_id", F.lit(name).alias("metric_name"), F.lit(granularity).alias("granularity"), "period", value.try_cast(VALUE).alias("value")
    )


def measure_sum(spec: MetricSpec) -> Column:
    """Rows, or the sum of the measure."""
    if spec.measure is None:
        return F.count("*")
    return F.sum(spec.measure().cast("bigint" if spec.narrow else VALUE))


def addresses(df: DataFrame, keys: tuple[str, ...], *rest) -> DataFrame:
    """Non-zero addresses of the key columns in column ``address``; one scan for both ends of a call."""
    out = df.select(*rest, F.explode(F.array(*[F.col(k) for k in keys])).alias("address")) if len(keys) > 1 else df.select(
        *rest, F.col(keys[0]).alias("address")
    )
    return out.where(non_zero("address"))


def metric(
    name: str, granularity: str, tables: dict[str, DataFrame], chain_id: int | None = None, first=None, last=None, approx: bool = False, exact: bool = False
) -> DataFrame:
    """One metric of the rows in [first, last), per chain and period. Periods without rows give no row.

    The value is a decimal, null for a volume beyond its 38 digits; with ``exact`` it is text of any length.
    """
    spec = SPECS[name]
    if exact and spec.kind != "token_volume":
        return metric(name, granularity, tables, chain_id, first, last, approx).withColumn("value", F.col("value").cast("string"))
    df = for_chain(tables[spec.source], chain_id)
    if spec.where is not None:
        df = df.where(spec.where())
    if spec.kind == "cumulative":
        out = cumulative_count(df, "block_time", granularity, first, last)
        return _named(out, name, granularity, F.col("value"))
    if spec.kind == "cumulative_distinct":
        out = cumulative_distinct(df, spec.keys, "block_time", granularity, first, last)
        return _named(out, name, granularity, F.col("value"))
    df = in_time_range(df, "block_time", first, last)
    if spec.kind == "token_volume":
        volume = token_volume(df, spec.token, spec.decimals, granularity)
        if exact:
            return volume.select("chain_id", F.lit(name).alias("metric_name"), F.lit(granularity).alias("granularity"), "period", "value")
        return _named(volume, name, granularity, F.col("value"))
    keyed = ["chain_id", period_start("block_time", granularity).alias("period")]
    if spec.kind == "distinct":
        counted = F.approx_count_distinct("address") if approx else F.count_distinct("address")
        out = addresses(df, spec.keys, *keyed).groupBy("chain_id", "period").agg(counted.alias("n"))
        return _named(out, name, granularity, F.col("n"))
    if spec.kind == "peak":
        per_second = df.groupBy(*keyed, second_bucket("block_time").alias("second")).agg(measure_sum(spec).alias("n"))
        return _named(per_second.groupBy("chain_id", "period").agg(F.max("n").alias("n")), name, granularity, F.col("n"))
    groups = df.groupBy(*keyed)
    if spec.kind == "max":
        return _named(groups.agg(F.max(spec.measure()).alias("n")), name, granularity, F.col("n"))
    if spec.kind == "avg":
        out = groups.agg(F.sum(spec.measure().cast(VALUE)).alias("s"), F.count(spec.measure()).alias("n"))
        return _named(out, name, granularity, trunc_div("s", "n"))
    out = groups.agg(measure_sum(spec).alias("n"))
    if spec.kind == "rate":
        return _named(out, name, granularity, trunc_div("n", period_seconds("period", granularity)))
    return _named(out, name, granularity, F.col("n"))


def token_volume(logs: DataFrame, token: str | None, decimals: int, granularity: str, signature: str = TRANSFER) -> DataFrame:
    """Whole coins moved per chain and period; all tokens apart (column ``address``) if ``token`` is None.

    The value is exact text: a sum of 256-bit amounts may pass the digits of a decimal, and 256 bits.
    """
    df = logs.where(bytes_in("topic0", [signature]) & (byte_length("data") == 32))
    keys = ["chain_id", period_start("block_time", granularity).alias("period")]
    if token is None:
        keys.append("address")
    else:
        df = df.where(bytes_in("address", [token]))
    out = df.groupBy(*keys).agg(limb_sums(u256_limbs("data")).alias("total"))
    return out.withColumn("value", quotient_text("total", 10**decimals)).drop("total")


def cumulative_count(df: DataFrame, ts: str, granularity: str, first=None, last=None, keys=("chain_id",)) -> DataFrame:
    """Rows up to the end of each period that has rows in [first, last).

    Earlier periods are counted in the same scan, so the running total needs no separate baseline.
    """
    counts = (
        in_time_range(df, ts, None, last)
        .groupBy(*keys, period_start(ts, granularity).alias("period"))
        .agg(F.count("*").alias("_n"), F.max(ts).alias("_latest"))
    )
    total = running_sum(counts, "_n", "period", list(keys), "value")
    if first is not None:
        total = total.where(F.col("_latest") >= F.lit(first))
    return total.select(*keys, "period", "value")


def first_seen(df: DataFrame, keys: tuple[str, ...], ts: str, by=("chain_id",)) -> DataFrame:
    """First time of every address: (chain_id, address, first_seen). Combines map-side."""
    return addresses(df, keys, *by, F.col(ts)).groupBy(*by, "address").agg(F.min(ts).alias("first_seen"))


def cumulative_distinct(
    df: DataFrame, keys: tuple[str, ...], ts: str, granularity: str, first=None, last=None, by=("chain_id",)
) -> DataFrame:
    """Distinct addresses seen up to the end of each period in which new ones appear.

    First appearances are taken over all history before ``last``, so a returning address is not
    counted again when periods are computed one batch at a time.
    """
    return cumulative_first_seen(first_seen(in_time_range(df, ts, None, last), tuple(keys), ts, by), granularity, first, by)


def cumulative_first_seen(seen: DataFrame, granularity: str, first=None, by=("chain_id",)) -> DataFrame:
    """The same from a stored table of first appearances."""
    return cumulative_count(seen, "first_seen", granularity, first, None, by)


def cumulative_from_metric(metrics: DataFrame, name: str, granularity: str, first=None, last=None, out: str | None = None) -> DataFrame:
    """Extend a stored cumulative metric: its last value before ``first`` plus the running sum of the regular one.

    ``name`` is the regular metric; the cumulative one is cumulative_<name>.  Of periods stored more than once the newest counts.
    """
    out = out or f"cumulative_{name}"
    current = metrics.where((F.col("granularity") == granularity) & F.col("metric_name").isin(name, out))
    if "computed_at" in current.columns:
        current = current_metrics(current)
    base = current.where(F.col("metric_name") == out)
    base = base.where(F.col("period") < F.lit(first)) if first is not None else base.where(F.lit(False))
    base = base.groupBy("chain_id").agg(F.max("value").alias("_base"))
    regular = in_time_range(current.where(F.col("metric_name") == name), "period", first, last)
    total = running_sum(regular, "value", "period", ["chain_id"], "_run").join(base, "chain_id", "left")
    return _named(total, out, granularity, F.col("_run") + F.coalesce("_base", F.lit(0)))


# --- many metrics, one scan per source -------------------------------------------------


def roll_up(df: DataFrame, grains: tuple[str, ...], extra: list, aggregates: list[Column], hour: str = "hour") -> DataFrame:
    """Hour rows aggregated to the given granularities (columns granularity, period)."""
    periods = F.array(*[F.struct(F.lit(g).alias("granularity"), period_start(hour, g).alias("period")) for g in grains])
    rest = [c for c in df.columns if c != hour]
    spread = df.select(*rest, F.inline(periods))
    return spread.groupBy("chain_id", "granularity", "period", *extra).agg(*aggregates)


def _seconds_of() -> Column:
    out = F.lit(None).cast("bigint")
    for g in GRANULARITIES:
        out = F.when(F.col("granularity") == g, period_seconds("period", g)).otherwise(out)
    return out


def _batch_additive(df: DataFrame, specs: list[MetricSpec], grains: tuple[str, ...]) -> DataFrame:
    """count, sum, max, avg, rate and peak metrics of one table: one scan, then small tables."""
    peaks = [s for s in specs if s.kind == "peak"]
    plain = [s for s in specs if s.kind != "peak"]

    def partial(spec: MetricSpec) -> list[Column]:
        n, m = spec.name, spec.measure
        if spec.kind == "max":
            return [F.max(m()).alias(n)]
        if spec.kind == "avg":
            return [measure_sum(spec).alias(n), F.count(m()).alias(f"{n}_rows")]
        if m is None and spec.where is not None:
            return [F.count_if(spec.where()).alias(n)]
        return [measure_sum(spec).alias(n)]

    def merge(spec: MetricSpec) -> list[Column]:
        n = spec.name
        if spec.kind in ("max", "peak"):
            return [F.max(n).alias(n)]
        total = F.sum(n) if spec.narrow or spec.measure is None else F.sum(n).cast(VALUE)
        return [total.alias(n)] + ([F.sum(f"{n}_rows").alias(f"{n}_rows")] if spec.kind == "avg" else [])

    if all(s.where is not None for s in specs):
        df = df.where(reduce(lambda a, b: a | b, [s.where() for s in specs]))
    bucket = second_bucket("block_time") if peaks else F.date_trunc("hour", "block_time")
    fine = df.groupBy("chain_id", bucket.alias("hour")).agg(*[c for s in specs for c in partial(s)])
    if peaks:
        fine = fine.groupBy("chain_id", F.date_trunc("hour", "hour").alias("hour")).agg(*[c for s in specs for c in merge(s)])
    rolled = roll_up(fine, grains, [], [c for s in plain + peaks for c in merge(s)])

    def final(spec: MetricSpec) -> Column:
        if spec.kind == "avg":
            return trunc_div(spec.name, f"{spec.name}_rows")
        if spec.kind == "rate":
            return trunc_div(F.col(spec.name), _seconds_of())
        # a filtered count without matching rows has no row in the series
        return F.when(F.col(spec.name) > 0, F.col(spec.name)) if spec.where is not None else F.col(spec.name)

    pairs = F.array(*[F.struct(F.lit(s.name).alias("metric_name"), final(s).cast(VALUE).alias("value")) for s in specs])
    return rolled.select("chain_id", "granularity", "period", F.inline(pairs)).where(F.col("value").isNotNull()).select(*SERIES)


def _batch_distinct(df: DataFrame, specs: list[MetricSpec], grains: tuple[str, ...], approx: bool = False) -> DataFrame:
    """Distinct metrics of one table: one scan to (hour, address, flags), then one distinct count per period.

    Exact counts cannot be added up, so the hourly address sets are spread to all granularities;
    with ``approx`` hourly sketches are merged instead.
    """
    if any(set(s.keys) - {"from", "to"} for s in specs):
        raise ValueError("distinct metrics count from and to")
    ends = F.array(
        F.struct(F.col("from").alias("address"), F.lit(True).alias("is_from")),
        F.struct(F.col("to").alias("address"), F.lit(False).alias("is_from")),
    )
    conditions = {s.name: (s.where() if s.where is not None else F.lit(True)) for s in specs}
    base = df.select(
        "chain_id",
        F.date_trunc("hour", "block_time").alias("hour"),
        *[c.alias(f"_{n}") for n, c in conditions.items()],
        F.inline(ends),
    ).where(non_zero("address"))
    flags = [
        F.max(F.col(f"_{s.name}") & (F.lit(True) if "to" in s.keys else F.col("is_from"))).alias(s.name) for s in specs
    ]
    hourly = base.groupBy("chain_id", "hour", "address").agg(*flags)
    if approx:
        sketches = hourly.groupBy("chain_id", "hour").agg(
            *[F.hll_sketch_agg(F.when(F.col(s.name), F.col("address"))).alias(s.name) for s in specs]
        )
        rolled = roll_up(sketches, grains, [], [F.hll_sketch_estimate(F.hll_union_agg(s.name)).alias(s.name) for s in specs])
    else:
        per_period = roll_up(hourly, grains, ["address"], [F.max(s.name).alias(s.name) for s in specs])
        rolled = per_period.groupBy("chain_id", "granularity", "period").agg(*[F.count_if(F.col(s.name)).alias(s.name) for s in specs])
    pairs = F.array(*[F.struct(F.lit(s.name).alias("metric_name"), F.col(s.name).cast(VALUE).alias("value")) for s in specs])
    return rolled.select("chain_id", "granularity", "period", F.inline(pairs)).where("value > 0").select(*SERIES)


def _batch_cumulative(df: DataFrame, spec: MetricSpec, grains: tuple[str, ...], first=None) -> DataFrame:
    """Cumulative metrics: first appearances (or rows) per hour, rolled up, then a running sum per series."""
    rows = df if spec.where is None else df.where(spec.where())
    if spec.kind == "cumulative":
        hourly = rows.groupBy("chain_id", F.date_trunc("hour", "block_time").alias("hour")).agg(
            F.count("*").alias("n"), F.max("block_time").alias("latest")
        )
    else:
        seen = first_seen(rows, spec.keys, "block_time")
        hourly = seen.groupBy("chain_id", F.date_trunc("hour", "first_seen").alias("hour")).agg(
            F.count("*").alias("n"), F.max("first_seen").alias("latest")
        )
    counts = roll_up(hourly, grains, [], [F.sum("n").alias("n"), F.max("latest").alias("latest")])
    total = running_sum(counts, "n", "period", ["chain_id", "granularity"], "value")
    if first is not None:
        total = total.where(F.col("latest") >= F.lit(first))
    return total.select("chain_id", F.lit(spec.name).alias("metric_name"), "granularity", "period", F.col("value").cast(VALUE).alias("value"))


def token_volume_batch(df: DataFrame, spec: MetricSpec, grains: tuple[str, ...]) -> DataFrame:
    """Volume of one token at several granularities from one scan: hourly limb sums, then sums of those.

    The value is exact text, as in ``token_volume``.
    """
    rows = df.where(bytes_in("topic0", [TRANSFER]) & bytes_in("address", [spec.token]) & (byte_length("data") == 32))
    hourly = rows.groupBy("chain_id", F.date_trunc("hour", "block_time").alias("hour")).agg(limb_sums(u256_limbs("data")).alias("total"))
    rolled = roll_up(hourly, grains, [], [limb_sums([F.col("total")[i] for i in range(LIMBS)]).alias("total")])
    return rolled.select("chain_id", F.lit(spec.name).alias("metric_name"), "granularity", "period", quotient_text("total", 10**spec.decimals).alias("value"))


def metric_batch(
    tables: dict[str, DataFrame], names: list[str] | None = None, chain_id: int | None = None, first=None, last=None, approx: bool = False,
    grains: tuple[str, ...] = GRANULARITIES, exact: bool = False,
) -> DataFrame:
    """Many metrics at several granularities; sources not in ``tables`` are skipped.

    With ``exact`` every value is text and volumes of any number of digits are exact, as in ``metric``.
    """
    kind = "string" if exact else VALUE
    specs = [SPECS[n] for n in (names or SPECS) if SPECS[n].source in tables]
    parts = []
    for source in dict.fromkeys(s.source for s in specs):
        history = in_time_range(for_chain(tables[source], chain_id), "block_time", None, last)
        ranged = in_time_range(history, "block_time", first, None)
        mine = [s for s in specs if s.source == source]
        additive = [s for s in mine if s.kind in ("count", "sum", "max", "avg", "rate", "peak")]
        distinct = [s for s in mine if s.kind == "distinct"]
        if additive:
            parts.append(_batch_additive(ranged, additive, grains))
        if distinct:
            parts.append(_batch_distinct(ranged, distinct, grains, approx))
        parts += [token_volume_batch(ranged, s, grains) for s in mine if s.kind == "token_volume"]
        parts += [_batch_cumulative(history, s, grains, first) for s in mine if s.kind.startswith("cumulative")]
    return reduce(DataFrame.unionByName, [p.withColumn("value", F.col("value").try_cast(kind)) for p in parts])


def only_complete(series: DataFrame, latest) -> DataFrame:
    """Rows whose period has ended by ``latest``, a time or a column."""
    latest = latest if isinstance(latest, Column) else F.lit(latest).cast("timestamp")
    done = F.lit(False)
    for g in GRANULARITIES:
        done = done | ((F.col("granularity") == g) & (next_period("period", g) <= latest))
    return series.where(done)


# --- reading stored series ---------------------------------------------------------------


def current_metrics(metrics: DataFrame) -> DataFrame:
    """Newest computed value per series and period."""
    return latest_by_key(metrics, ["chain_id", "metric_name", "granularity", "period"], "computed_at", ["value"])


def fill_periods(series: DataFrame, start: Column, end: Column, granularity: str, keys: list[str] | None = None) -> DataFrame:
    """Every period from start up to and excluding end for each series, 0 where it has no value.

    The spine is one row per series and period; series are few, so it is small.
    """
    keys = keys or []
    steps = F.sequence(start, end - interval(granularity), interval(granularity))
    if keys:
        spine = series.select(*keys).distinct().select(*keys, F.explode(steps).alias("period"))
    else:
        spine = series.sparkSession.range(1).select(F.explode(steps).alias("period"))
    return spine.join(series, [*keys, "period"], "left").withColumn("value", F.coalesce("value", F.lit(0)))


def metric_series(metrics: DataFrame, chain_id: int | None, name: str, preset: str, as_of) -> DataFrame:
    """One stored metric over a preset range with zero-filled gaps, oldest period first."""
    back, granularity = range_preset(preset)
    now = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    start = period_start(now - F.expr(f"INTERVAL {back}"), granularity)
    end = period_start(now, granularity) + interval(granularity)
    rows = for_chain(metrics, chain_id).where(
        (F.col("metric_name") == name) & (F.col("granularity") == granularity) & (F.col("period") >= start)
    )
    rows = current_metrics(rows).where(F.col("period") < end).select("chain_id", "period", "value")
    filled = fill_periods(rows, start, end, granularity, ["chain_id"])
    return _named(filled, name, granularity, F.col("value")).orderBy("chain_id", "period")


def metric_names(metrics: DataFrame, chain_id: int | None, granularity: str) -> DataFrame:
    return for_chain(metrics, chain_id).where(F.col("granularity") == granularity).select("metric_name").distinct()

