"""Sort, limit and paging. A sort with a limit keeps only the best rows per task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockloom.constants import ROWS_PER_PAGE


def sort(df: DataFrame, cols: list) -> DataFrame:
    return df.orderBy(*cols)


def top_k(df: DataFrame, by, k: int, then: list | None = None) -> DataFrame:
    """k rows with the greatest ``by``; ``then`` breaks ties."""
    return df.orderBy(_desc(by), *(then or [])).limit(k)


def latest(df: DataFrame, by: str, k: int, then: list | None = None) -> DataFrame:
    return top_k(df, by, k, then)


def _desc(c) -> Column:
    return F.desc(c) if isinstance(c, str) else c.desc()


def rank_order(df: DataFrame, col: str, order: list, then: list[Column]) -> DataFrame:
    """Sort by the position of ``col`` in ``order`` (others last), then by ``then``."""
    rank = F.lit(len(order))
    for i, value in reversed(list(enumerate(order))):
        rank = F.when(F.col(col) == value, i).otherwise(rank)
    return df.orderBy(rank, *then)


def numeric_text(col: str) -> Column:
    """Number in a text column, 0 where it is not one."""
    return F.coalesce(F.col(col).try_cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))


def sort_numeric_text(df: DataFrame, col: str, then: list | None = None) -> DataFrame:
    return df.orderBy(numeric_text(col).desc(), *(then or []))


def sort_limit(df: DataFrame, col, direction: str | None = None, n: int | None = None, then: list | None = None) -> DataFrame:
    c = F.col(col) if isinstance(col, str) else col
    if direction:
        df = df.orderBy(c.desc() if direction == "desc" else c.asc(), *(then or []))
    return df if n is None else df.limit(n)


def merge_sorted(a: DataFrame, b: DataFrame, by: str, then: list | None = None) -> DataFrame:
    return a.unionByName(b).orderBy(by, *(then or []))


def page(df: DataFrame, order: list, n: int, size: int = ROWS_PER_PAGE) -> DataFrame:
    """Page ``n`` (from 0). For deep paging filter on the last key seen instead: ``page_after``."""
    return df.orderBy(*order).offset(n * size).limit(size)


def page_after(df: DataFrame, key: str | list[str], last, size: int = ROWS_PER_PAGE) -> DataFrame:
    """The page that follows ``last``; cost does not grow with the page number.

    ``key`` names the columns of a unique order, so that rows that tie in the first are neither lost nor repeated;
    ``last`` holds their values in the last row seen, None for the first page.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if last is not None:
        values = [F.lit(v) for v in (last if isinstance(last, (tuple, list)) else [last])]
        df = df.where(F.col(keys[0]) >= values[0])  # reaches the scan, which a comparison of structs does not
        df = df.where(F.struct(*keys) > F.struct(*[v.alias(k) for v, k in zip(values, keys, strict=True)]))
    return df.orderBy(*keys).limit(size)
