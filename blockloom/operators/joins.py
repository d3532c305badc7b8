"""Joins.

No broadcast hint is given anywhere: adaptive execution broadcasts a side once its measured
size is below spark.sql.autoBroadcastJoinThreshold and splits skewed partitions otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockloom.operators.windows import first_per_key, running_sum


def join_inner(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    return a.join(b, keys, "inner")


def active_by_type(state: DataFrame, subnets: DataFrame, types: list[str], count: str = "subnet_id", out: str = "active") -> DataFrame:
    """Distinct ``count`` among active validators of subnets of the given types."""
    wanted = subnets.where(F.col("subnet_type").isin(*types)).select("p_chain_id", "subnet_id")
    return (
        state.where("active").join(wanted, ["p_chain_id", "subnet_id"], "left_semi").agg(F.count_distinct(count).alias(out))
    )


def enrich(df: DataFrame, dims: list[tuple[DataFrame, list[str]]], defaults: dict | None = None) -> DataFrame:
    """Left join dimensions with unique keys; unmatched columns get explicit defaults."""
    for dim, keys in dims:
        df = df.join(dim, keys, "left")
    return df.select(*[F.coalesce(F.col(c), F.lit(defaults[c])).alias(c) if c in (defaults or {}) else F.col(c) for c in df.columns])


def enrich_agg(df: DataFrame, aggs: list[DataFrame], keys: list[str], defaults: dict | None = None) -> DataFrame:
    """Left join tables already aggregated to one row per key."""
    return enrich(df, [(a, keys) for a in aggs], defaults)


def enrich_first(df: DataFrame, dim: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Left join only the first dimension row per key."""
    return df.join(first_per_key(dim, keys, order), keys, "left")


def merge_full(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join; columns both sides have take a's value, then b's."""
    both = [c for c in a.columns if c in b.columns and c not in keys]
    renamed = b.select(*[F.col(c).alias(f"_b_{c}") if c in both else F.col(c) for c in b.columns])
    joined = a.join(renamed, keys, "full_outer")
    out = []
    for c in dict.fromkeys(keys + a.columns + b.columns):
        out.append(F.coalesce(F.col(c), F.col(f"_b_{c}")).alias(c) if c in both else F.col(c))
    return joined.select(*out)


def not_in(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.join(b.select(key), key, "left_anti")


def missing_from(table: DataFrame, snapshot: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``table`` whose key the snapshot does not have."""
    return table.join(snapshot.select(*keys), keys, "left_anti")


def compare(a: DataFrame, b: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Two computations of the same table side by side, matched by key, with a ``match`` flag."""
    left = a.select(*keys, *[F.col(c).alias(f"{c}_a") for c in cols])
    right = b.select(*keys, *[F.col(c).alias(f"{c}_b") for c in cols])
    same = reduce(lambda x, y: x & y, [F.col(f"{c}_a").eqNullSafe(F.col(f"{c}_b")) for c in cols])
    return left.join(right, keys, "full_outer").withColumn("match", same)


def with_scalar(df: DataFrame, name: str, scalar_df: DataFrame) -> DataFrame:
    """Add the value of a one-row, one-column DataFrame; it runs once, as a scalar subquery."""
    return df.withColumn(name, scalar_df.scalar())


def sum_in_span(
    spans: DataFrame,
    events: DataFrame,
    key: str | list[str],
    span_id: str | list[str],
    start: str = "start_time",
    end: str = "end_time",
    exclusive: str = "start_exclusive",
    ts: str = "block_time",
    amount: str = "amount",
    out: str = "total",
    width: int | None = 86400 * 30,
) -> DataFrame:
    """Per span, the sum of events of the key with start <= ts <= end (start < ts where ``exclusive``).

    Span ends and events are put on one time line per key; the sum of a span is the running
    total at its end less the one at its start.  No (span, event) pairs are built, so a key
    with many spans and many events stays linear.
    """
    number = F.lit(0).cast("decimal(38,0)")
    keys, ids = [key] if isinstance(key, str) else key, [span_id] if isinstance(span_id, str) else span_id
    span = F.struct(*ids)
    marks = spans.select(
        *keys,
        F.explode(
            F.array(
                F.struct(F.col(start).alias("at"), F.when(F.col(exclusive), 2).otherwise(0).alias("rank"), F.lit(-1).alias("sign")),
                F.struct(F.col(end).alias("at"), F.lit(2).alias("rank"), F.lit(1).alias("sign")),
            )
        ).alias("m"),
        span.alias("_span"),
    ).select(*keys, "m.at", "m.rank", "m.sign", "_span", number.alias("_amount"))
    points = events.select(
        *keys,
        F.col(ts).alias("at"),
        F.lit(1).alias("rank"),
        F.lit(0).alias("sign"),
        F.lit(None).cast(spans.select(span.alias("s")).schema["s"].dataType).alias("_span"),
        F.col(amount).cast("decimal(38,0)").alias("_amount"),
    )
    line = running_sum(marks.unionByName(points), "_amount", "at", keys, "_run", width, ["rank"])
    sums = line.where("sign <> 0").groupBy("_span").agg(F.sum(F.col("_run") * F.col("sign")).cast("decimal(38,0)").alias(out))
    return spans.join(sums.select("_span.*", out), ids, "left")


def lookup_first(df: DataFrame, sources: list[DataFrame], key: str | list[str], col: str, out: str | None = None) -> DataFrame:
    """``col`` from the first source that has the key; every source is reduced to one row per key."""
    names, key = [], [key] if isinstance(key, str) else key
    for i, source in enumerate(sources):
        name = f"_{col}_{i}"
        df = df.join(source.groupBy(*key).agg(F.min(col).alias(name)), key, "left")
        names.append(name)
    return df.withColumn(out or col, F.coalesce(*names)).drop(*names)


def zip_explode(df: DataFrame, arrays: list[str], pos: str = "pos") -> DataFrame:
    """One row per position of parallel arrays; a shorter array gives NULL."""
    rest = [c for c in df.columns if c not in arrays]
    return df.select(*rest, F.posexplode(F.arrays_zip(*arrays)).alias(pos, "_item")).select(
        *rest, pos, *[F.col(f"_item.{a}").alias(a) for a in arrays]
    )
