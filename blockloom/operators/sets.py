"""Unions. Two projections of one table are one scan and an explode, not two scans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_endpoints(df: DataFrame, a: str, b: str, out: str = "address") -> DataFrame:
    """Every row twice, once with column ``a`` and once with ``b`` as ``out``."""
    rest = [c for c in df.columns if c not in (a, b)]
    return df.select(*rest, F.explode(F.array(F.col(a), F.col(b))).alias(out))


def union_missing(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b, allowMissingColumns=True)


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()
