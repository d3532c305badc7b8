"""Packing against exact small instances and the tokenizer library, and its edge cases."""

import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq

from blockloom.llm import packing as P
from blockloom.llm import queries

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def library():
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(VOCABULARY)


def fewest(items, capacity):
    """The least number of sequences, by trying every place for every piece."""
    items, best = sorted(items, reverse=True), [len(items)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for room in {r for r in rooms if r >= items[i]}:
            k = rooms.index(room)
            go(i + 1, [*rooms[:k], room - items[i], *rooms[k + 1 :]])
        go(i + 1, [*rooms, capacity - items[i]])

    go(0, [])
    return best[0]


def test_reduction_keeps_a_best_packing():
    random.seed(1)
    reduced = 0
    for _ in range(1500):
        capacity = random.choice([7, 10, 20, 30])
        items = [random.randint(1, capacity) for _ in range(random.randint(0, 10))]
        counts = np.bincount(items, minlength=capacity + 1).astype(np.int64) if items else np.zeros(capacity + 1, np.int64)
        rest = counts.copy()
        fixed = P.reduce_instance(rest, capacity)
        reduced += len(items) - int(rest.sum())
        left = [n for n in range(capacity + 1) for _ in range(rest[n])]
        assert sum(t for _, t in fixed) + fewest(left, capacity) == fewest(items, capacity)
        done = fixed + P.best_fit(rest, capacity)
        assert all(sum(n * k for n, k in pattern) <= capacity for pattern, _ in done)
        used = Counter()
        for pattern, times in done:
            for n, k in pattern:
                used[n] += k * times
        assert used == Counter(items)
    assert reduced > 3000


def test_best_fit_is_the_sequential_one():
    random.seed(2)
    for _ in range(300):
        items = sorted((random.randint(1, 30) for _ in range(random.randint(1, 60))), reverse=True)
        rooms = []
        for n in items:
            fit = [r for r in rooms if r >= n]
            if fit:
                rooms.remove(min(fit))
                rooms.append(min(fit) - n)
            else:
                rooms.append(30 - n)
        done = P.best_fit(np.bincount(items, minlength=31).astype(np.int64), 30)
        assert sum(t for _, t in done) == len(rooms)


def test_plan_stays_small():
    rng = np.random.default_rng(0)
    lengths = np.clip(rng.exponential(400, 2_000_000).astype(int) + 1, 1, 2048)
    places = P.plan(np.bincount(lengths, minlength=2049).astype(np.int64), 2048)
    assert len(places["length"]) < 20_000
    assert places["sequence"].max() + 1 <= 1.01 * -(-lengths.sum() // 2048)


def check_packed(rows, capacity):
    """Places are gapless; returns the number of sequences."""
    own = defaultdict(list)
    for r in rows:
        own[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in own.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(own)


def test_whole_table(spark, folder):
    texts = {r["doc_id"]: r["text"] for r in pq.read_table(f"{folder}/documents.parquet").to_pylist()}
    own = library()
    want, total = {}, 0
    for doc, text in texts.items():
        ids = np.array([*own.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        total += len(ids)
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            want[doc, piece] = (start, len(part), zlib.crc32(part.tobytes()))
    rows = queries.op13_best_fit_packing(spark, folder).collect()
    assert len(rows) == len(want)
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == want
    lengths = np.array([n for _, n, _ in want.values()])
    plain = P.best_fit(np.bincount(lengths, minlength=2049).astype(np.int64), 2048)
    assert -(-total // 2048) <= check_packed(rows, 2048) <= sum(t for _, t in plain)


def test_encoder_is_the_library(monkeypatch):
    own, encoder = library(), P.WordEncoder(open(VOCABULARY, "rb").read())
    monkeypatch.setattr(P, "SLICE", 40)
    monkeypatch.setattr(P, "MAX_WORDS", 30)
    random.seed(4)
    letters = "aAéİıßΣσς'’stdm 09²½.,!?-_|\t\n\r\x0b\x1c\x85\xa0 ́漢字ﬁ\U0001f600ȺǅЯ"
    fixed = ["", " ", "<|endoftext|>", "a<|startoftext|>b", "don't we'll I'D they've", "x" * 500, "ÀÈ Ñandú ÿ", "é ́e", "KK"]
    for text in fixed + ["".join(random.choices(letters, k=random.randint(1, 120))) for _ in range(3000)]:
        assert encoder.ids(text).tolist() == own.encode(text, add_special_tokens=False).ids, repr(text)


def test_edges(spark):
    long = "word and " * 4000
    rows = [(1, None, 0), (2, "", 0), (2, "", 0), (None, "a b c.", 0), (3, long, 1), (3, long, 2)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, length int").toDF("doc_id", "text", "length").withColumn("TASK", frame_lit())
    packed = P.pack(frame, VOCABULARY, capacity=64, with_ids=True)
    got = packed.collect()
    check_packed(got, 64)
    assert sum(r["length"] for r in got) == 3 + len(library().encode("a b c.").ids) + 1 + 2 * 8001
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"] for r in got)
    whole = P.sequences(packed).collect()
    assert sum(len(r["ids"]) for r in whole) == sum(r["length"] for r in got) and all(len(r["ids"]) <= 64 for r in whole)
    assert all(r["starts"][0] == 0 and len(r["documents"]) == len(r["starts"]) for r in whole)
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert P.pack(empty, VOCABULARY).count() == 0


def frame_lit():
    from pyspark.sql import functions as F

    return F.lit("x")
