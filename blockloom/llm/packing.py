"""Packing of tokenised documents into sequences of a fixed length: Martello-Toth reduction, then best fit.

1. One pass tokenises every whole text, ends it with ``end`` and cuts what is longer than ``capacity`` into pieces of that
   length, the last of which may be shorter.  A piece gets its number among the pieces of its length in its task.
2. Pieces of one length are interchangeable, so the instance is the histogram of lengths: at most ``capacity`` counts,
   whatever the corpus.  It alone reaches the driver.
3. *Reduction* (:func:`reduce_instance`): for a length, largest first, a set of at most three pieces that holds it and
   dominates every other set that does (each of their pieces, apart from it, fits into a slot of the set, several into one
   where their sum does) is in some best packing; it is fixed as often as the counts allow.  Fixing only takes pieces away,
   which leaves the conditions true.
4. *Best fit decreasing* packs what is left (:func:`best_fit`), by classes of equally filled sequences.
5. The plan, a list of patterns with their multiplicities (of a size bounded by ``capacity`` alone), goes to the tasks.  A
   piece's number among all of its length, which is its number in its task plus the counts of earlier tasks, picks its place.

Defined results: a null text counts as empty and gives one piece that holds ``end`` alone.  Rows equal in id and text are
packed each.  Null ids stay null.  Of a very long text only a slice is split into words at a time.  An empty table packs
into nothing.  Which of two pieces of equal length goes where follows the order of the input files.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blockloom.llm.tables import pick, stored
from blockloom.llm.token_counts import _LETTER, _NUMBER, _PLAIN

CAPACITY = 2048
#: Words whose ids a worker keeps, twice; characters of a text split into words at once; pieces in a batch of output.
MAX_WORDS, SLICE, BATCH = 500_000, 1 << 20, 4_096

_SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^\s{_LETTER}{_NUMBER}]+")
_END_OF_WORD = "</w>"


class WordEncoder:
    """Ids of a vocabulary whose words end with a mark and whose white space is dropped, as the library gives them.

    Words of a text in plain letters are looked up; unknown ones go to the library together, and the marks tell them apart
    in what it returns.  Other texts go to the library as they are, a slice between two spaces at a time.
    """

    def __init__(self, blob: bytes):
        from tokenizers import Tokenizer

        spec = json.loads(blob)
        self.library = Tokenizer.from_str(blob.decode())
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.ends = np.zeros(self.library.get_vocab_size(), bool)
        self.ends[[i for t, i in spec["model"]["vocab"].items() if t.endswith(_END_OF_WORD)]] = True
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _of(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)

    def _learn(self, words: list[str]) -> None:
        ids = self._of(" ".join(words))
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) == len(words):
            data, at = ids.tobytes(), 0
            for word, end in zip(words, (4 * ends).tolist()):
                self.words[word] = data[at:end]
                at = end
        else:
            for word in words:
                self.words[word] = self._of(word).tobytes()

    def _slice(self, text: str) -> bytes:
        low = text.lower()
        if not _PLAIN(low) or any(s in text for s in self.special):
            return self._of(text).tobytes()
        words = _SPLIT.findall(low)
        distinct = set(words)
        unknown = distinct.difference(self.words)
        if unknown and len(self.words) + len(unknown) > MAX_WORDS:  # words in use come back from the older half
            self.words, self.older = {}, self.words
            unknown = distinct
        if unknown and self.older:
            back = {w: self.older[w] for w in unknown if w in self.older}
            self.words.update(back)
            unknown -= back.keys()
        if unknown:
            self._learn(list(unknown))
        return b"".join(map(self.words.__getitem__, words))

    def ids(self, text: str) -> np.ndarray:
        parts, at = [], 0
        while at < len(text):
            to = at + SLICE
            if to < len(text):
                to = text.find(" ", to)
                to = len(text) if to < 0 else to
            parts.append(self._slice(text[at:to]))
            at = to
        return np.frombuffer(b"".join(parts), np.uint32)


_encoders: dict[bytes, WordEncoder] = {}


def encoder(blob: bytes) -> WordEncoder:
    """The encoder of a vocabulary file, kept in the worker."""
    key = hashlib.blake2b(blob, digest_size=16).digest()
    if key not in _encoders:
        _encoders[key] = WordEncoder(blob)
    return _encoders[key]


Pattern = tuple[tuple[int, int], ...]  # (length, copies) of the pieces of a sequence


def _fixed_set(counts: np.ndarray, j: int, capacity: int) -> tuple[int, ...] | None:
    """Lengths of a set with one piece of length ``j`` that dominates every feasible set with it, if one is known."""
    rest, room = counts.copy(), capacity - j
    rest[j] -= 1
    lengths = np.flatnonzero(rest[: room + 1])
    if not len(lengths):
        return (j,)
    small = np.repeat(lengths[:3], np.minimum(rest[lengths[:3]], 3))[:3]  # the three least pieces
    x = int(lengths[-1])
    if x == room or len(small) < 2 or small[:2].sum() > room:  # it fills the rest, or no two fit
        return (j, x)
    if len(small) == 3 and small.sum() <= room:
        return None
    # at most two more fit: pairs a >= b, for each a the largest b
    at = np.searchsorted(lengths, np.minimum(lengths, room - lengths), "right") - 1
    own = (at >= 0) & (lengths[at] == lengths) & (rest[lengths] < 2)
    at = np.where(own, at - 1, at)
    fits = at >= 0
    if (lengths[fits] + lengths[at[fits]]).max(initial=0) <= x:
        return (j, x)
    if not fits[-1]:
        return None
    b = int(lengths[at[-1]])
    above = lengths[lengths > b]
    above = np.repeat(above[:2], np.minimum(rest[above[:2]], 2))[:2]
    if len(above) < 2 or above.sum() > room:  # no feasible pair has both pieces longer than b
        return (j, x, b)
    return None


def reduce_instance(counts: np.ndarray, capacity: int) -> list[tuple[Pattern, int]]:
    """Fix dominating sets until there are none; ``counts`` (by length) is left with the remainder."""
    fixed, changed = [], True
    while changed:
        changed = False
        for j in range(capacity, 0, -1):
            while counts[j] and (found := _fixed_set(counts, j, capacity)):
                pattern = tuple(Counter(found).items())
                times = min(int(counts[n]) // k for n, k in pattern)
                for n, k in pattern:
                    counts[n] -= k * times
                fixed.append((pattern, times))
                changed = True
    return fixed


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[Pattern, int]]:
    """Best fit in decreasing order, by classes of sequences that are filled alike."""
    room: dict[int, list[tuple[Pattern, int]]] = {}
    sizes: list[int] = []  # of the rooms there are, in order
    done = []

    def keep(left: int, pattern: Pattern, times: int) -> None:
        if not left:
            done.append((pattern, times))
        elif times:
            if left not in room:
                room[left] = []
                insort(sizes, left)
            room[left].append((pattern, times))

    for length in range(capacity, 0, -1):
        n = int(counts[length])
        while n:
            i = bisect_left(sizes, length)
            left = sizes[i] if i < len(sizes) else capacity
            if i < len(sizes):
                pattern, times = room[left].pop()
                if not room[left]:
                    del room[left], sizes[i]
            else:
                pattern, times = (), n
            most = left // length
            full = min(times, n // most)
            if full:
                keep(left - most * length, (*pattern, (length, most)), full)
                n -= full * most
                times -= full
            if n and times:  # fewer are left than the next one holds
                keep(left - n * length, (*pattern, (length, n)), 1)
                n, times = 0, times - 1
            if pattern:
                keep(left, pattern, times)
    return done + [entry for entries in room.values() for entry in entries]


def plan(counts: np.ndarray, capacity: int) -> dict[str, np.ndarray]:
    """Places by (length, number): runs of pieces of a length with their first sequence and offset, in order."""
    rest = counts.copy()
    patterns = reduce_instance(rest, capacity) + best_fit(rest, capacity)
    used = np.zeros(capacity + 1, np.int64)
    rows, sequence = [], 0
    for pattern, times in patterns:
        offset = 0
        for length, copies in pattern:
            rows.append((length, used[length], times, sequence, offset))
            used[length] += copies * times
            offset += copies * length
        sequence += times
    rows = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "times", "sequence", "offset"), rows.T))


def pieces_of(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end: int = 0, with_ids: bool = False, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32, task, nth) of every piece; with ``ids`` if asked for."""
    with open(vocabulary, "rb") as f:  # a few megabytes, handed to the tasks with the code
        blob = f.read()
    rows = pick(docs, id=id, text=text).select("id", F.col("text").cast("string"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, task int, nth bigint" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, task, seen = encoder(blob), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        last = np.array([end], np.uint32)
        for batch in batches:
            out: list[tuple] = []

            def made() -> pa.RecordBatch:
                at, piece, start, length, crc, nth, ids = zip(*out)
                lists = [pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32()))] if with_ids else []
                columns = [batch["id"].take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array([task] * len(at), pa.int32()), pa.array(nth, pa.int64()), *lists]
                return pa.RecordBatch.from_arrays(columns, names=["id", "piece", "start", "length", "ids_crc32", "task", "nth", *["ids"] * with_ids])

            for i, value in enumerate(batch["text"]):
                ids = np.concatenate([own.ids(value.as_py() or ""), last])
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    out.append((i, piece, start, len(part), zlib.crc32(part.astype("<u4").tobytes()), int(seen[len(part)]), part if with_ids else None))
                    seen[len(part)] += 1
                    if len(out) >= BATCH:
                        yield made()
                        out.clear()
            if out:
                yield made()

    return rows.mapInArrow(run, schema)


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (a stored table) with ``sequence_id`` and ``offset``."""
    counts = stored(pieces.groupBy("task", "length").agg(F.count("*").alias("n")))
    histogram = np.zeros(capacity + 1, np.int64)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # ``capacity`` rows at most
        histogram[row["length"]] = row["n"]
    places = plan(histogram, capacity)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    numbered = pieces.join(offsets, ["task", "length"]).withColumn("nth", F.col("nth") + F.col("before")).drop("task", "before")
    names = [c for c in numbered.columns if c != "nth"]
    schema = ", ".join(f"`{c}` {numbered.schema[c].dataType.simpleString()}" for c in names) + ", sequence_id bigint, offset bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = np.searchsorted(places["length"], np.arange(capacity + 2))  # of the runs of each length
        shift = np.int64(int(histogram.max(initial=0)) + 1)
        keys = places["length"] * shift + places["first"] if len(starts) else np.zeros(0, np.int64)
        for batch in batches:
            length, nth = (np.asarray(batch[c]) for c in ("length", "nth"))
            at = np.searchsorted(keys, length * shift + nth, "right") - 1
            copy, sequence = np.divmod(nth - places["first"][at], places["times"][at])
            made = [pa.array(places["sequence"][at] + sequence), pa.array(places["offset"][at] + copy * length)]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in names), *made], names=[*names, "sequence_id", "offset"])

    return numbered.mapInArrow(run, schema)


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end: int = 0, with_ids: bool = False, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every row of ``docs``."""
    placed = place(stored(pieces_of(docs, vocabulary, capacity, end, with_ids, id, text)), capacity)
    extra = ["ids"] * with_ids
    return placed.select(F.col("id").alias(id), "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *extra)


def sequences(packed: DataFrame, id: str = "doc_id") -> DataFrame:
    """(sequence_id, ids, documents, starts): the packed token ids, with the pieces' documents and offsets in order."""
    parts = F.array_sort(F.collect_list(F.struct("offset", F.col(id).alias("id"), "ids")))
    whole = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    return whole.select("sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.id").alias("documents"), F.col("parts.offset").alias("starts"))
