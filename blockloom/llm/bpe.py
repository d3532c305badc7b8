"""Byte-level BPE encoding of whole texts by overlapping chunks, and decoding.

A text of up to ``CHUNK`` characters is encoded where it is.  A longer one is cut into chunks that overlap by ``OVERLAP``
characters and are dealt over the cluster:

1. each chunk is split into pre-tokens on its own; near its seams the places of the splits are kept;
2. from a place that two neighbouring chunks both split at, they split alike to the end, since the pattern only looks
   forward: there the pre-tokens have come into step again.  The first such place in the overlap, if it lies between an
   ASCII letter and a space, becomes a cut.  Without one the text up to the end stays one piece, which is right but not
   parallel (a single run of letters longer than the overlap);
3. the pieces between cuts start and end where the whole text splits, so each is encoded by itself and the ids joined.

Decoding looks up the bytes of each id and concatenates them; it works on ids alone.  Null texts count as empty and give
no ids.  Rows with equal ids and texts are separate rows with equal results.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockloom.llm.tables import each_batch, pick

CHUNK = 24_000
OVERLAP = 1_000

_encoders: dict[bytes, object] = {}


def ranks_of(path: str) -> bytes:
    """The rank file's content; a few megabytes at most, handed to the tasks with the code."""
    with open(path, "rb") as f:
        return f.read()


def _table(blob: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in blob.splitlines() if line)}


def encoder(blob: bytes, pattern: str):
    """The library's encoder of a rank file, kept in the worker."""
    import tiktoken

    key = hashlib.blake2b(blob + pattern.encode(), digest_size=16).digest()
    if key not in _encoders:
        _encoders[key] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=_table(blob), special_tokens={})
    return _encoders[key]


def _lists(found: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
    values = np.concatenate(found) if found else np.zeros(0, np.uint32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values.astype(np.int32), pa.int32()))


def _encode(blob: bytes, pattern: str, keep: tuple[str, ...]):
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = encoder(blob, pattern)
        found = [own.encode_to_numpy(t or "", disallowed_special=()) for t in batch["text"].to_pylist()]
        return pa.RecordBatch.from_pydict({**{k: batch[k] for k in keep}, "ids": _lists(found)})

    return each_batch(work)


def _seams(pattern: str, chunk: int, overlap: int):
    """Places in the text (characters) where a chunk splits, at its left and at its right seam."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        import regex

        split = regex.compile(pattern)
        left, right = [], []
        for c, text in zip(batch["chunk"].to_pylist(), batch["text"].to_pylist()):
            starts = np.array([m.start() for m in split.finditer(text)], np.int64)
            letters = np.frombuffer(text.encode("utf-32-le"), np.uint32)
            # splits between an ASCII letter and a space, not at the very end, where what follows is unknown
            inner = starts[(starts > 0) & (starts < len(text) - 1)]
            before = letters[inner - 1] | 32
            inner = inner[(before >= 97) & (before <= 122) & (letters[inner] == 32)]
            left.append((inner[inner < overlap] + c * chunk).tobytes())
            right.append((inner[inner >= chunk] + c * chunk).tobytes())
        return pa.RecordBatch.from_pydict({"key": batch["key"], "chunk": batch["chunk"], "left": pa.array(left, pa.binary()), "right": pa.array(right, pa.binary())})

    return each_batch(work)


def _cuts(key, rows: pd.DataFrame) -> pd.DataFrame:
    """The cuts of one text: at each seam the first place at which both chunks split, until a seam has none."""
    rows = rows.sort_values("chunk")
    cuts = [0]
    for right, left in zip(rows["right"].iloc[:-1], rows["left"].iloc[1:]):
        both = np.intersect1d(np.frombuffer(right, np.int64), np.frombuffer(left, np.int64))
        if not len(both):
            break
        cuts.append(int(both[0]))
    return pd.DataFrame({"key": [key[0]], "cuts": [np.array(cuts, np.int64)]})


def encode(docs: DataFrame, ranks: bytes, pattern: str, id: str = "doc_id", text: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(id, ids) of every row, as the library encodes the whole text without special tokens."""
    rows = pick(docs, id=id, text=text).select("id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    size = F.length("text")
    short = rows.where(size <= chunk).mapInArrow(_encode(ranks, pattern, ("id",)), f"id {kind}, ids array<int>")
    long = rows.where(size > chunk).withColumn("key", F.sha2("text", 256))
    texts = long.select("key", "text").dropDuplicates(["key"])
    numbers = F.explode(F.sequence(F.lit(0), F.floor((size - 1) / chunk).cast("int"))).alias("chunk")
    chunks = texts.select("key", numbers, "text").select("key", "chunk", F.substr("text", F.col("chunk") * chunk + 1, F.lit(chunk + overlap)).alias("text"))
    seams = chunks.repartition("key", "chunk").mapInArrow(_seams(pattern, chunk, overlap), "key string, chunk int, left binary, right binary")
    cuts = seams.groupBy("key").applyInPandas(_cuts, "key string, cuts array<bigint>")
    pieces = texts.join(cuts, "key").select("key", F.posexplode("cuts").alias("piece", "start"), "cuts", "text")
    to = F.coalesce(F.try_element_at("cuts", F.col("piece") + 2), F.length("text").cast("bigint"))
    pieces = pieces.select("key", "piece", F.substr("text", (F.col("start") + 1).cast("int"), (to - F.col("start")).cast("int")).alias("text"))
    encoded = pieces.repartition("key", "piece").mapInArrow(_encode(ranks, pattern, ("key", "piece")), "key string, piece int, ids array<int>")
    whole = encoded.groupBy("key").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("piece", "ids"))), lambda x: x["ids"])).alias("ids"))
    joined = long.select("id", "key").join(whole, "key").select("id", "ids")
    return short.unionByName(joined).withColumnRenamed("id", id)


def decode(encoded: DataFrame, ranks: bytes, ids: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``, the bytes of its ids one after the other; null ids give no bytes."""
    cache: dict[str, pa.Array] = {}

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if "words" not in cache:
            table = _table(ranks)
            words = [b""] * (max(table.values()) + 1)
            for word, rank in table.items():
                words[rank] = word
            cache["words"] = pa.array(words, pa.large_binary())
        column = batch.column(place)
        lists = pa.LargeListArray.from_arrays(column.offsets.cast(pa.int64()), cache["words"].take(column.values))
        decoded = pc.if_else(column.is_valid(), pc.binary_join(lists, pa.scalar(b"", pa.large_binary())), pa.scalar(b"", pa.large_binary()))
        return pa.RecordBatch.from_arrays([*batch.columns, decoded.cast(pa.binary())], names=[*batch.schema.names, "decoded"])

    place = encoded.columns.index(ids)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(each_batch(work), f"{schema}, decoded binary")


def with_digests(decoded: DataFrame) -> DataFrame:
    """``n_tokens`` and SHA-256 of the decimal ids joined by commas and of the decoded bytes."""
    return decoded.withColumns(
        {
            "n_tokens": F.size("ids").cast("bigint"),
            "ids_sha256": F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256),
            "decoded_sha256": F.sha2("decoded", 256),
        }
    )
