"""Ranked lexical search: a K2-treap over the term-document grid of each range of documents.

*Grid.*  Documents are taken as they lie in the input, in ranges of about ``RANGE_TERMS`` term occurrences; a range is a row
of the index.  Its grid has a row for each of its terms (frequent ones first) and a column for each document.  A filled cell
holds the term's impact there, ``10**9 * tf div (1000 * tf + 12 * m)``, which rises with the frequency and falls with the
length of the document; the weight of a term is the same in its whole row and is applied at the query.

*K2-treap.*  The grid is halved in both directions again and again (in rows alone while there are more rows than columns).
Each quarter that holds a filled cell is a node with the largest impact in it.  A level is stored as one bit for each
possible child and, for those there are, by how much their maximum lies below their parent's.

*Query.*  The rows of an item's terms are known, so each term follows one path of row halves, while columns branch.  All
terms descend together: the weighted maxima of their nodes above a range of columns bound the score of each document in it.
The best bounds are opened first, :data:`OPENED` at a time; what cannot reach the k-th best score so far, which a task
carries from range to range, is never opened.  Bounds are exact at single documents.

Items are a stated query set: they go to the tasks in blocks of about ``BLOCK_TERMS`` terms, one pass over the index each.
The k best of each task are merged by item, through salted groups first.

Terms are told apart by 64-bit hashes.  Defined results: null and empty texts, and those without a term, have no cell and
do not count in N; items without terms have no rows.  Every row of ``docs`` is a document of its own, also with an id that
repeats; null ids rank before others.  Items equal in id and text count once.  A document longer than a range is a range.
An empty index gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blockloom.llm.tables import pick, stored
from blockloom.llm.words import SLICE_BYTES, pieces, raw, slices, span_hashes

#: Term occurrences of a range, nodes opened at once, terms of items that go to the tasks at once.
RANGE_TERMS, OPENED, BLOCK_TERMS = 2_000_000, 256, 200_000
SALTS = 32

_TERM = np.zeros(256, bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_COUNT = np.array([bin(x).count("1") for x in range(16)], np.int32)


def _bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the terms of texts that lie one after the other."""
    inside = _TERM[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def _parts(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of the first text, bytes, offsets) of slices; a long text comes in several that end between terms."""
    data, offsets = raw(column)
    for at, to in slices(offsets):
        part = data[offsets[at] : offsets[to]]
        if to - at == 1 and len(part) > 2 * SLICE_BYTES:
            yield from ((at, x, np.array([0, len(x)])) for x in pieces(part))
        else:
            yield at, part, offsets[at : to + 1] - offsets[at]


def term_hashes(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of the first text, hashes of all terms, n+1 offsets into them); a long text comes in several parts."""
    for at, data, offsets in _parts(column):
        starts, ends = _bounds(data, offsets)
        yield at, span_hashes(data, starts, ends, lower=True), np.searchsorted(starts, offsets)


def statistics(docs: DataFrame, text: str = "text") -> tuple[int, int]:
    """N, the documents with a term, and L, all terms with repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents = terms = 0
        for batch in batches:
            n = np.zeros(batch.num_rows, np.int64)
            for at, data, offsets in _parts(batch["text"]):
                starts, _ = _bounds(data, offsets)
                n[at : at + len(offsets) - 1] += np.diff(np.searchsorted(starts, offsets))
            documents, terms = documents + np.count_nonzero(n), terms + int(n.sum())
        yield pa.RecordBatch.from_pydict({"n": pa.array([documents], pa.int64()), "l": pa.array([terms], pa.int64())})

    row = pick(docs, text=text).select(F.col("text").cast("string")).mapInArrow(run, "n bigint, l bigint").agg(F.sum("n"), F.sum("l")).first()
    return int(row[0] or 0), int(row[1] or 0)


def _pack(x: np.ndarray, codec: str = "zstd") -> bytes:
    """An array's length, then its bytes by place (high bytes are mostly zero), compressed."""
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T
    return len(x).to_bytes(8, "little") + pa.compress(np.ascontiguousarray(planes).tobytes(), codec=codec, asbytes=True)


def _unpack(blob: bytes, kind: type, codec: str = "zstd") -> np.ndarray:
    n, size = int.from_bytes(blob[:8], "little"), np.dtype(kind).itemsize
    if not n:
        return np.zeros(0, kind)
    planes = np.frombuffer(pa.decompress(blob[8:], decompressed_size=n * size, codec=codec, asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, n).T).view(kind).reshape(-1)


def _spread(x: np.ndarray) -> np.ndarray:
    """The bits of 31-bit numbers with a zero before each."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


def _levels(code: np.ndarray, impact: np.ndarray, steps: list[int]) -> tuple[list[np.ndarray], list[np.ndarray], int]:
    """Children's bits of each node and children's distances to its maximum, level by level from the top, and the maximum.

    ``steps`` has 1 or 2 address bits for each level.  ``code`` is in order.
    """
    bits, below = [], []
    for step in reversed(steps):
        parent = code >> np.uint64(step)
        starts = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]]))
        most = np.maximum.reduceat(impact, starts)
        sizes = np.diff(np.append(starts, len(code)))
        child = np.left_shift(np.uint8(1), (code & np.uint64((1 << step) - 1)).astype(np.uint8))
        bits.append(np.bitwise_or.reduceat(child, starts))
        below.append((np.repeat(most, sizes) - impact).astype(np.uint32))
        code, impact = parent[starts], most
    return bits[::-1], below[::-1], int(impact[0])


INDEX = "documents binary, n int, terms binary, numbers binary, frequency binary, shape array<int>, bits array<binary>, maxima array<binary>"
_INDEX = pa.schema([("documents", pa.binary()), ("n", pa.int32()), ("terms", pa.binary()), ("numbers", pa.binary()), ("frequency", pa.binary()), ("shape", pa.list_(pa.int32())), ("bits", pa.list_(pa.binary())), ("maxima", pa.list_(pa.binary()))])
_NULL_ID = np.iinfo(np.int64).min


def _grid(ids: np.ndarray, column: np.ndarray, terms: np.ndarray, total: int, documents: int) -> pa.RecordBatch:
    """One row of the index from term occurrences (column, hash); ``ids`` by column."""
    lengths = np.bincount(column, minlength=len(ids))
    m = 75 + 25 * lengths * documents // total
    known, row = np.unique(terms, return_inverse=True)
    cells, tf = np.unique(row.astype(np.uint64) * np.uint64(len(ids)) + column.astype(np.uint64), return_counts=True)
    row, column = np.divmod(cells, np.uint64(len(ids)))
    impact = 1_000_000_000 * tf // (1000 * tf + 12 * m[column.astype(np.int64)])
    frequency = np.bincount(row.astype(np.int64), minlength=len(known))
    number = np.empty(len(known), np.uint32)  # rows of the grid: frequent terms first
    number[np.argsort(-frequency, kind="stable")] = np.arange(len(known), dtype=np.uint32)
    c = max(len(ids) - 1, 0).bit_length()
    r = max((len(known) - 1).bit_length(), c)
    row = number[row.astype(np.int64)].astype(np.uint64)
    low = np.uint64((1 << c) - 1)
    code = (row >> np.uint64(c)) << np.uint64(2 * c) | _spread(row & low) << np.uint64(1) | _spread(column)
    order = np.argsort(code, kind="stable")
    bits, below, top = _levels(code[order], impact[order], [1] * (r - c) + [2] * c)
    values = [_pack(ids), len(ids), _pack(known), _pack(number), _pack(frequency.astype(np.uint32)), [r, c, top], [_pack(x) for x in bits], [_pack(x) for x in below]]
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _INDEX)], schema=_INDEX)


def build_index(docs: DataFrame, id: str = "doc_id", text: str = "text", range_terms: int = RANGE_TERMS) -> tuple[DataFrame, int]:
    """The index, a stored table with a row for each range of documents, and N."""
    rows = pick(docs, id=id, text=text).select(F.col("id").cast("bigint"), F.col("text").cast("string"))
    documents, total = statistics(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, columns, terms, held = [], [], [], 0

        def made() -> pa.RecordBatch:
            out = _grid(np.array(ids, np.int64), np.concatenate(columns), np.concatenate(terms), total, documents)
            for x in (ids, columns, terms):
                x.clear()
            return out

        for batch in batches:
            own = np.asarray(batch["id"].fill_null(_NULL_ID))
            last = None  # the text that the column added last belongs to
            for at, found, ends in term_hashes(batch["text"]):
                for i in range(len(ends) - 1):
                    part = found[ends[i] : ends[i + 1]]
                    if not len(part):
                        continue
                    if last != at + i:
                        if held >= range_terms:
                            yield made()
                            held = 0
                        ids.append(own[at + i])
                        last = at + i
                    columns.append(np.full(len(part), len(ids) - 1, np.int32))
                    terms.append(part)
                    held += len(part)
        if held:
            yield made()

    return stored(rows.mapInArrow(run, INDEX)), documents


@dataclass
class Treap:
    """A decoded row of the index; the last node of each level stands for "none"."""

    ids: np.ndarray
    terms: np.ndarray
    numbers: np.ndarray
    r: int
    c: int
    masks: list[np.ndarray]
    first: list[np.ndarray]
    most: list[np.ndarray]

    @classmethod
    def of(cls, row: dict) -> Treap:
        r, c, top = row["shape"]
        masks, first, most = [], [], [np.array([top, 0], np.int64)]
        for bits, below in zip(row["bits"], row["maxima"]):
            mask = _unpack(bits, np.uint8)
            children = _COUNT[mask]
            first.append(np.append(np.cumsum(children, dtype=np.int32) - children, 0))
            masks.append(np.append(mask, np.uint8(0)))
            most.append(np.append(np.repeat(most[-1][:-1], children) - _unpack(below, np.uint32), 0))
        return cls(_unpack(row["documents"], np.int64), _unpack(row["terms"], np.uint64), _unpack(row["numbers"], np.uint32).astype(np.int64), r, c, masks, first, most)

    def child(self, level: int, nodes: np.ndarray, quarter: np.ndarray) -> np.ndarray:
        mask = self.masks[level][nodes]
        own = np.left_shift(np.uint8(1), quarter.astype(np.uint8))
        there = (mask & own) != 0
        return np.where(there, self.first[level][nodes] + _COUNT[mask & (own - np.uint8(1))], len(self.most[level + 1]) - 1)

    def rows(self, terms: np.ndarray) -> np.ndarray:
        """Row numbers of terms, -1 where a term is in no document of the range."""
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, self.numbers[at], -1)

    def best(self, rows: np.ndarray, weights: np.ndarray, top: Top) -> int:
        """Offer ``top`` every document that may belong there; the number of column ranges opened."""
        flat = self.r - self.c
        nodes = np.zeros(len(rows), np.int64)
        for level in range(flat):
            nodes = self.child(level, nodes, rows >> (self.r - 1 - level) & 1)
        # by level: bounds, first columns (shifted down to the level) and a node for each term, of ranges not opened yet
        waiting = {flat: (self.most[flat][nodes][None, :] @ weights, np.zeros(1, np.int64), nodes[None, :])}
        opened = 0
        while waiting:
            level = max(waiting, key=lambda k: (waiting[k][0].max(), k))
            bounds, columns, nodes = waiting.pop(level)
            keep = np.flatnonzero(bounds >= top.least)
            if level == flat + self.c:
                top.offer(bounds[keep], self.ids[columns[keep]])
                continue
            if len(keep) > OPENED:
                keep = keep[np.argsort(-bounds[keep], kind="stable")]
                rest = keep[OPENED:]
                waiting[level] = bounds[rest], columns[rest], nodes[rest]
                keep = keep[:OPENED]
            if not len(keep):
                continue
            opened += len(keep)
            half = rows >> (self.r - 1 - level) & 1
            below = np.stack([self.child(level, nodes[keep], 2 * half + b) for b in (0, 1)], axis=1).reshape(-1, len(rows))
            bounds = self.most[level + 1][below] @ weights
            columns = (columns[keep][:, None] * 2 + np.arange(2)).reshape(-1)
            keep = bounds >= top.least
            found = bounds[keep], columns[keep], below[keep]
            if len(found[0]):
                before = waiting.get(level + 1)
                waiting[level + 1] = tuple(map(np.concatenate, zip(before, found))) if before else found
        return opened


class Top:
    """The k best (score, document) of an item so far; equal scores by ascending document."""

    def __init__(self, k: int):
        self.k, self.least = k, 1
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if not len(scores):
            return
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == self.k:
            self.least = max(int(self.scores[-1]), 1)


def _items(items: DataFrame, id: str, text: str) -> DataFrame:
    """A stored table (item_id, terms, times) of distinct items: sorted hashes of the terms and how often each occurs."""
    rows = pick(items, id=id, text=text).select("id", F.col("text").cast("string")).distinct()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[list[np.ndarray]] = [[] for _ in range(batch.num_rows)]
            for at, hashes, ends in term_hashes(batch["text"]):
                for i in range(len(ends) - 1):
                    found[at + i].append(hashes[ends[i] : ends[i + 1]])
            counted = [np.unique(np.concatenate(x or [np.zeros(0, np.uint64)]), return_counts=True) for x in found]
            columns = {"item_id": batch["id"], "terms": pa.array([a.tobytes() for a, _ in counted], pa.binary()), "times": pa.array([b.astype(np.int64).tobytes() for _, b in counted], pa.binary())}
            yield pa.RecordBatch.from_pydict(columns)

    kind = rows.schema["id"].dataType.simpleString()
    return stored(rows.mapInArrow(work, f"item_id {kind}, terms binary, times binary").where(F.length("terms") > 0))


def _frequencies(index: DataFrame, terms: np.ndarray) -> np.ndarray:
    """Documents of the whole index that hold each of ``terms``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(terms), np.int64)
        for batch in batches:
            for known, frequency in zip(batch["terms"].to_pylist(), batch["frequency"].to_pylist()):
                known = _unpack(known, np.uint64)
                at = np.minimum(np.searchsorted(known, terms), len(known) - 1)
                total += np.where(known[at] == terms, _unpack(frequency, np.uint32)[at], 0)
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"term": pa.array(full, pa.int64()), "df": pa.array(total[full], pa.int64())})

    out = np.zeros(len(terms), np.int64)
    for row in index.select("terms", "frequency").mapInArrow(run, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[row["term"]] = row["df"]  # a row for each term of the block at most
    return out


def weight(documents: int, frequency: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * frequency + 1)))


def _found(index: DataFrame, queries: list[tuple[np.ndarray, np.ndarray]], k: int) -> DataFrame:
    """(item, doc_id, score): the k best documents of each task for each query (terms, weights)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops = [Top(k) for _ in queries]
        every = np.concatenate([t for t, _ in queries] or [np.zeros(0, np.uint64)])
        ends = np.cumsum([0, *(len(t) for t, _ in queries)])
        for batch in batches:
            for i in range(batch.num_rows):
                treap = Treap.of({c: batch[c][i].as_py() for c in batch.schema.names})
                rows = treap.rows(every)
                for q, (_, weights) in enumerate(queries):
                    own = rows[ends[q] : ends[q + 1]]
                    here = own >= 0
                    if here.any():
                        treap.best(own[here], weights[here], tops[q])
        sizes = [len(t.ids) for t in tops]
        ids = np.concatenate([t.ids for t in tops] or [np.zeros(0, np.int64)])
        yield pa.RecordBatch.from_pydict(
            {
                "item": pa.array(np.repeat(np.arange(len(tops)), sizes), pa.int64()),
                "doc_id": pa.array(ids, pa.int64(), mask=ids == _NULL_ID),
                "score": pa.array(np.concatenate([t.scores for t in tops] or [np.zeros(0, np.int64)]), pa.int64()),
            }
        )

    return index.mapInArrow(run, "item bigint, doc_id bigint, score bigint")


def _first(df: DataFrame, k: int, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first())
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(index: DataFrame, documents: int, items: DataFrame, k: int = 20, id: str = "item_id", text: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents above 0 of every item, equal scores by ascending id."""
    asked = _items(items, id, text)
    kind = asked.schema["item_id"].dataType.simpleString()
    size = asked.agg(F.sum(F.length("terms")) / 8).first()[0] or 0
    blocks = max(1, math.ceil(size / block_terms))
    parts = []
    for b in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("terms", "item_id"), F.lit(blocks)) == b).collect()  # a block of bounded size
        if not rows:
            continue
        own = [(np.frombuffer(r["terms"], np.uint64), np.frombuffer(r["times"], np.int64)) for r in rows]
        terms = np.unique(np.concatenate([t for t, _ in own]))
        weights = np.array([weight(documents, int(n)) if n else 0 for n in _frequencies(index, terms)], np.int64)
        queries = []
        for t, times in own:
            w = weights[np.searchsorted(terms, t)] * times
            queries.append((t[w > 0], w[w > 0]))
        found = _found(index, queries, k).withColumn("salt", F.spark_partition_id() % SALTS)
        best = _first(_first(found, k, "item", "salt"), k, "item").select("item", F.col("rank").cast("int"), "doc_id", "score")
        names = index.sparkSession.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], f"item bigint, item_id {kind}")
        parts.append(best.join(names, "item").select(F.col("item_id").alias(id), "rank", "doc_id", "score"))
    if not parts:
        return asked.select(F.col("item_id").alias(id), F.lit(0).alias("rank"), F.lit(0).cast("bigint").alias("doc_id"), F.lit(0).cast("bigint").alias("score")).limit(0)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER = "".join(map(chr, range(65, 91)))


def oracle(k: int = 20) -> str:
    """The same ranking from word lists, in DuckDB."""
    terms = f"regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '{TERM}')"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS d, doc_id, {terms} AS terms FROM documents),
lengths AS (SELECT d, doc_id, len(terms) AS n FROM docs WHERE len(terms) > 0),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM lengths),
items AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(terms) AS term FROM
  (SELECT DISTINCT item_id, text, {terms} AS terms FROM benchmark)) GROUP BY ALL),
cells AS (SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(terms) AS term FROM docs)
  WHERE term IN (SELECT term FROM items) GROUP BY ALL),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM cells GROUP BY term), corpus),
impacts AS (SELECT doc_id, term, (1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total)) AS impact, d
  FROM cells JOIN lengths USING (d), corpus),
scores AS (SELECT item_id, d, doc_id, CAST(sum(times * w * impact) AS BIGINT) AS score
  FROM items JOIN weights USING (term) JOIN impacts USING (term) GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (SELECT item_id, doc_id, score,
  row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0) WHERE rank <= {k}"""
