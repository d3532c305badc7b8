"""Counts of hashes over a whole corpus in a fixed number of counters.

A counter holds the occurrences of all hashes that share its leading bits, so it is never less than any one hash's own
count.  The size does not depend on the corpus: ``1 << BITS`` integers, small enough to go to the driver and to each task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 18
SLICES = 64
_WIDTH = (1 << BITS) // SLICES


def counter_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


def counted(batches: Iterator[pa.RecordBatch], hashes: Callable[[pa.RecordBatch], Iterator[np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """One row (slice, counts) for each non-empty slice of a task's counters."""
    total = np.zeros(1 << BITS, np.int64)
    for batch in batches:
        for found in hashes(batch):
            total += np.bincount(counter_of(found), minlength=1 << BITS)
    yield from rows(total)


def rows(total: np.ndarray) -> Iterator[pa.RecordBatch]:
    parts = total.reshape(SLICES, _WIDTH)
    full = np.flatnonzero(parts.any(axis=1))
    yield pa.RecordBatch.from_pydict({"slice": pa.array(full, pa.int32()), "counts": pa.array([parts[i].tobytes() for i in full], pa.binary())})


def _sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, blob in zip(batch["slice"].to_pylist(), batch["counts"].to_pylist()):
            got = np.frombuffer(blob, np.int64)
            total[k] = total[k] + got if k in total else got
    yield pa.RecordBatch.from_pydict({"slice": pa.array(list(total), pa.int32()), "counts": pa.array([v.tobytes() for v in total.values()], pa.binary())})


def gather(parts: DataFrame) -> np.ndarray:
    """The counters of all tasks, summed slice by slice on the executors."""
    total = np.zeros((SLICES, _WIDTH), np.int64)
    summed = parts.select("slice", "counts").repartition(SLICES, F.col("slice")).mapInArrow(_sum, "slice int, counts binary")
    for row in summed.collect():  # SLICES rows of a fixed size
        total[row["slice"]] += np.frombuffer(row["counts"], np.int64)
    return total.reshape(-1)
