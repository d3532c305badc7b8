"""Document fingerprints: a homomorphic multiset hash of paragraphs.

Each element of a text is hashed to a vector of ``LANES`` signs; the fingerprint is their sum modulo 2**16 a lane, after
the number of lines modulo 2**32.  The elements are the paragraphs (lines with any character) and the pieces into which
words whose hash is 0 modulo ``PIECE_WORDS`` cut them, so that an edit touches few elements of a long paragraph.  So

- texts with the same paragraphs in any order have the same fingerprint, others differ but for a chance of about 2**-64;
- fingerprints of parts add up: inserting or deleting a paragraph adds or subtracts its own fingerprint (:func:`add`);
- the squared length of a difference estimates the number of differing elements, from which :func:`likeness` comes: 1 for
  equal ones, about 0 for unrelated ones, in between the shared part of both, within about ``1 / sqrt(LANES / 2)``.

For the neighbour of each document the rows are dealt by ranges of the id and sorted there; the first document of a range
also goes to the range before, and the very first to the last.  Null texts count as empty, null ids sort first, rows with
the same id follow each other by text; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockloom.llm.tables import pick
from blockloom.llm.words import SLICE_BYTES, mix, pieces, raw, slices, span_hashes, spans

LANES = 256
PIECE_WORDS = 8
_U = np.uint64
_LINE, _PIECE = _U(0x5851F42D4C957F2D), _U(0x14057B7EF767814F)
_LANE_SALT = mix(np.arange(1, LANES // 64 + 1, dtype=_U) * _U(0x9E3779B97F4A7C15))
_GIANT = 2 * SLICE_BYTES


def _signs(elements: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each text the sum of its elements' sign vectors."""
    n = len(ends) - 1
    out = np.zeros((n, LANES), np.int64)
    full = np.flatnonzero(np.diff(ends))
    if len(full):
        bits = np.unpackbits(mix(elements[:, None] ^ _LANE_SALT[None, :]).view(np.uint8).reshape(len(elements), -1), axis=1)
        ones = np.add.reduceat(bits, ends[full], axis=0, dtype=np.int64)
        out[full] = 2 * ones - np.diff(ends)[full][:, None]
    return out


def _elements(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all elements of texts that lie one after the other, and n+1 offsets into them."""
    s = spans(data, offsets)
    hashes = s.hashes()
    breaks = np.flatnonzero(data == 0x0A)
    first = offsets[:-1][np.diff(offsets) > 0]
    # lines: from a start to the next break or the end of the text
    edges = np.unique(np.concatenate([first, breaks + 1, [len(data)]]))
    starts, ends = edges[:-1], edges[1:]
    ends = ends - (data[ends - 1] == 0x0A) if len(ends) else ends
    some = ends > starts
    lines, owner_l = span_hashes(data, starts[some], ends[some]), np.searchsorted(offsets, starts[some], "right") - 1
    cuts = s.ends[hashes % _U(PIECE_WORDS) == 0]
    edges = np.unique(np.concatenate([edges, cuts[cuts < len(data)]]))
    starts, ends = edges[:-1], edges[1:]
    ends = ends - (data[ends - 1] == 0x0A) if len(ends) else ends
    some = ends > starts
    parts, owner_p = span_hashes(data, starts[some], ends[some]), np.searchsorted(offsets, starts[some], "right") - 1
    owner = np.concatenate([owner_l, owner_p])
    order = np.argsort(owner, kind="stable")
    return np.concatenate([mix(lines ^ _LINE), mix(parts ^ _PIECE)])[order], np.searchsorted(owner[order], np.arange(len(offsets)))


def _long(data: np.ndarray) -> np.ndarray:
    """The vector of one long text, from groups of whole lines; a giant line is cut from its own start."""
    total = np.zeros(LANES, np.int64)
    edges = np.concatenate([[0], np.flatnonzero(data == 0x0A) + 1, [len(data)]])
    at = 0
    while at < len(edges) - 1:
        to = max(int(np.searchsorted(edges, edges[at] + SLICE_BYTES, "right")) - 1, at + 1)
        part = data[edges[at] : edges[to]]
        if len(part) <= _GIANT:
            found, ends = _elements(part, np.array([0, len(part)]))
            total += _signs(found, ends)[0]
        else:
            line = part[:-1] if part[-1] == 0x0A else part
            whole = np.frombuffer(hashlib.blake2b(line.tobytes(), digest_size=8).digest(), _U)
            total += _signs(mix(whole ^ _LINE), np.array([0, 1]))[0]
            for piece in pieces(line):
                found, ends = _elements(piece, np.array([0, len(piece)]))
                total += _signs(found, ends)[0]
        at = to
    return total


def vectors(column: pa.Array) -> np.ndarray:
    """Fingerprints of texts: one row each of the number of lines and the lanes."""
    data, offsets = raw(column)
    out = np.zeros((len(column), LANES + 1), np.int64)
    for at, to in slices(offsets):
        part = data[offsets[at] : offsets[to]]
        own = offsets[at : to + 1] - offsets[at]
        if to - at == 1 and len(part) > _GIANT:
            out[at, 1:] = _long(part)
        else:
            out[at:to, 1:] = _signs(*_elements(part, own))
        breaks = np.concatenate([[0], np.cumsum(part == 0x0A)])
        out[at:to, 0] = breaks[own[1:]] - breaks[own[:-1]] + (np.diff(own) > 0)
    return out


def to_text(vector: np.ndarray) -> str:
    return (np.array([vector[0]]).astype(np.uint32).tobytes() + vector[1:].astype(np.uint16).tobytes()).hex()


def from_text(text: str) -> np.ndarray:
    blob = bytes.fromhex(text)
    return np.concatenate([np.frombuffer(blob[:4], np.uint32).astype(np.int64), np.frombuffer(blob[4:], np.int16).astype(np.int64)])


def add(a: str, b: str, sign: int = 1) -> str:
    """The fingerprint after inserting the lines of ``b`` (sign 1) or deleting them (sign -1)."""
    return to_text(from_text(a) + sign * from_text(b))


def _near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    wrap = lambda x: x.astype(np.uint16).astype(np.int16).astype(float)
    apart = (wrap(a[:, 1:] - b[:, 1:]) ** 2).sum(axis=1)
    both = (wrap(a[:, 1:]) ** 2).sum(axis=1) + (wrap(b[:, 1:]) ** 2).sum(axis=1)
    near = np.clip(1 - apart / np.maximum(both, 1), 0, 1)
    return np.where((a.astype(np.uint16) == b.astype(np.uint16)).all(axis=1), 1.0, np.where(both == 0, 0.0, near))


def likeness(a: str, b: str) -> float:
    return float(_near(from_text(a)[None, :], from_text(b)[None, :])[0])


def fingerprint(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fingerprint) of every row."""
    rows = pick(docs, id=id, text=text).select("id", F.col("text").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"id": batch["id"], "fingerprint": pa.array([to_text(v) for v in vectors(batch["text"])], pa.string())})

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, fingerprint string").withColumnRenamed("id", id)


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of (bucket, ahead, id): each row that isn't a look-ahead with the one after it."""
    held: pa.RecordBatch | None = None

    def out(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ahead = batch["ahead"].to_pylist()
        texts = [t or "" for t in batch["text"].to_pylist()]
        rows = [i for i in range(batch.num_rows - 1) if not ahead[i]]
        if not rows:
            return
        edited = []
        for i in rows:
            k = len(texts[i]) // 4
            edited.append(texts[i][: len(texts[i]) - k] + texts[i + 1][:k])
        own, changed = vectors(pa.array(texts, pa.large_string())), vectors(pa.array(edited, pa.large_string()))
        this, after = own[rows], own[[i + 1 for i in rows]]
        yield pa.RecordBatch.from_pydict(
            {
                "id": batch["id"].take(pa.array(rows)),
                "n_chars": pa.array([len(texts[i]) for i in rows], pa.int64()),
                "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in edited],
                "fingerprint": [to_text(v) for v in this],
                "edited_fingerprint": [to_text(v) for v in changed],
                "near_edited": _near(this, changed),
                "near_next": _near(this, after),
            }
        )

    for batch in batches:
        if batch.num_rows:
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            yield from out(batch)
            held = batch.slice(batch.num_rows - 1)


def compare_edited(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's fingerprint beside that of its edited text, whose last quarter is the start of the next document."""
    rows = pick(docs, id=id, text=text).select(F.col("id").cast("bigint"), F.col("text").cast("string"))
    spark = docs.sparkSession
    buckets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = rows.withColumn("at", F.coalesce("id", F.lit(-(1 << 63))))
    shares = F.array(*[F.lit(i / buckets) for i in range(buckets)])
    # starts of ranges: ids that occur, the least of all first
    got = keyed.agg(F.min("at").alias("least"), F.percentile_approx("at", shares, 100 * buckets).alias("starts")).first()
    starts = sorted({got["least"], *(got["starts"] or [])} - {None})
    schema = "id bigint, text string, at bigint, bucket int, ahead boolean"

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch["at"].to_pylist()
            own = [bisect.bisect_right(starts, x) - 1 for x in at]
            first = [i for i, x in enumerate(at) if starts[own[i]] == x]
            before = [own[i] - 1 if own[i] else len(starts) - 1 for i in first]
            yield pa.RecordBatch.from_pydict({**{c: batch[c] for c in ("id", "text", "at")}, "bucket": pa.array(own, pa.int32()), "ahead": pa.array([False] * len(own))})
            if first:
                more = batch.take(pa.array(first))
                yield pa.RecordBatch.from_pydict({**{c: more[c] for c in ("id", "text", "at")}, "bucket": pa.array(before, pa.int32()), "ahead": pa.array([True] * len(first))})

    ranged = keyed.mapInArrow(dealt, schema).repartition(buckets, F.col("bucket")).sortWithinPartitions("bucket", "ahead", "at", F.xxhash64("text"), "text")
    out = "id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return ranged.mapInArrow(_compared, out).withColumnRenamed("id", id)
