"""Helpers of the operators: columns by exact name, joins with a side of checked size, shared intermediates."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockloom.session import prepare, scratch

#: Rows up to which the small side of a join is broadcast; checked by counting.
BROADCAST_ROWS = 100_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def pick(df: DataFrame, **wanted: str | None) -> DataFrame:
    """The named columns under new names: ``pick(df, key="doc_id")``.

    Columns are matched by exact name and taken by place, so further columns of any name, repeated or different in case
    only, do not matter.  ``None`` gives a null text column.
    """
    places = {name: i for i, name in reversed(list(enumerate(df.columns)))}
    missing = [c for c in wanted.values() if c is not None and c not in places]
    if missing:
        raise ValueError(f"no column {', '.join(missing)}")
    plain = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    return plain.select(*[(F.lit(None).cast("string") if c is None else F.col(f"_c{places[c]}")).alias(n) for n, c in wanted.items()])


class Carried:
    """A table whose columns are renamed out of the way, and given back under their names by :meth:`back`."""

    def __init__(self, df: DataFrame, **wanted: str | None):
        self.names = df.columns
        places = {name: i for i, name in reversed(list(enumerate(self.names)))}
        missing = [c for c in wanted.values() if c is not None and c not in places]
        if missing:
            raise ValueError(f"no column {', '.join(missing)}")
        own = [f"_c{i}" for i in range(len(self.names))]
        self.place = {n: None if c is None else f"_c{places[c]}" for n, c in wanted.items()}
        extra = [(F.lit(None).cast("string") if c is None else F.col(c)).alias(n) for n, c in self.place.items()]
        self.df = df.toDF(*own).select(*own, *extra)

    def back(self, df: DataFrame, replaced: Mapping[str, str] | None = None, added: Iterable[str] = ()) -> DataFrame:
        """Original columns of ``df``; ``replaced`` names new values of wanted ones, ``added`` new columns.

        A new column takes the place of an original one of the same name, whatever the case.
        """
        added = list(added)
        new = {a.lower() for a in added}
        instead = {self.place[k]: v for k, v in (replaced or {}).items()}
        out = [F.col(instead.get(f"_c{i}", f"_c{i}")).alias(n) for i, n in enumerate(self.names) if n.lower() not in new]
        return df.select(*out, *added)


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept as a table in the cluster's shared folder.

    A table rather than a checkpoint: a checkpoint hands on the size estimates of its plan, and those of joins multiply
    with each round, until planning takes longer than the work; a table is planned by its true size.
    """
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_small(large: DataFrame, small: DataFrame, on: str, salts: int = 16, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Left join with one row a key on the small side: broadcast up to ``limit`` counted rows, salted beyond.

    The salted way deals the rows of a frequent key over ``salts`` tasks and repeats each small row for them.
    """
    small = stored(small)
    if small.count() <= limit:
        return large.join(F.broadcast(small), on, "left")
    rest = [F.col(c) for c in large.columns if c != on]
    left = large.withColumn("_salt", F.pmod(F.xxhash64(on, *rest), F.lit(salts)))
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")))
    return left.join(right, [on, "_salt"], "left").drop("_salt")


def give_back() -> None:
    """Return freed memory to the machine: workers are kept between tasks, and what one task freed the next may not fit into."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def each_batch(work: Callable[[pa.RecordBatch], pa.RecordBatch | None]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow that handles each batch on its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := work(batch)) is not None:
                yield out
        give_back()

    return run
