"""Ranked search against DuckDB and plain Python, and its edge cases."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from oracle import compare

from blockloom.llm import lexical_search as S
from blockloom.llm import queries

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def ranked(docs, items, k):
    """{(item, rank): (doc, score)} by plain counting; ``docs`` and ``items`` are lists of (id, text)."""
    found = [(d, Counter(terms(t))) for d, t in docs]
    found = [(d, c, sum(c.values())) for d, c in found if c]
    n, total = len(found), sum(x for _, _, x in found)
    out = {}
    for item, text in dict.fromkeys(items):
        scores = []
        for d, own, length in found:
            m = 75 + 25 * length * n // total
            score = 0
            for t, times in Counter(terms(text)).items():
                if t in own:
                    df = sum(t in c for _, c, _ in found)
                    score += times * S.weight(n, df) * (1_000_000_000 * own[t] // (1000 * own[t] + 12 * m))
            if score > 0:
                scores.append((-score, d is not None, d or 0))
        for rank, (score, there, d) in enumerate(sorted(scores)[:k], 1):
            out[item, rank] = (d if there else None, -score)
    return out


def run(spark, docs, items, k=20, **sizes):
    block = {"block_terms": sizes.pop("block_terms")} if "block_terms" in sizes else {}
    index, n = S.build_index(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(2), **sizes)
    rows = S.search(index, n, spark.createDataFrame(items, "item_id bigint, text string"), k, **block).collect()
    out = {(r["item_id"], r["rank"]): (r["doc_id"], r["score"]) for r in rows}
    assert len(out) == len(rows)
    return out


def test_whole_table(spark, folder):
    assert compare(queries.op12_ranked_search(spark, folder), S.oracle(), folder) is None


def test_terms_match_plain_python(monkeypatch):
    monkeypatch.setattr("blockloom.llm.words.SLICE_BYTES", 64)
    monkeypatch.setattr(S, "SLICE_BYTES", 64)
    some = ["a B  c", "", None, "ä-b\n\tc", "Word " * 60, "z" * 400, "x_y@Z[1]", "漢字 É", "."]
    own = {}
    for at, hashes, ends in S.term_hashes(pa.array(some)):
        for i in range(len(ends) - 1):
            own.setdefault(at + i, []).extend(hashes[ends[i] : ends[i + 1]].tolist())
    known = {}
    for i, text in enumerate(some):
        words = terms(text)
        assert len(own.get(i, [])) == len(words)
        assert all(known.setdefault(w, h) == h for w, h in zip(words, own.get(i, [])))
    assert len(set(known.values())) == len(known)


def test_treap_holds_every_cell_and_its_maxima():
    rng = np.random.default_rng(1)
    for documents, words in ((1, 1), (1, 50), (37, 3), (64, 700), (130, 9)):
        n = int(rng.integers(1, 400))
        column, word = np.sort(rng.integers(0, documents, n)), rng.integers(0, words, n).astype(np.uint64) * np.uint64(977)
        ids, column = np.unique(column, return_inverse=True)
        row = S._grid(ids.astype(np.int64), column.astype(np.int32), word, n, len(ids))
        treap = S.Treap.of({c: row[c][0].as_py() for c in row.schema.names})
        lengths, cells = np.bincount(column), Counter(zip(word.tolist(), column.tolist()))
        impact = {k: 10**9 * tf // (1000 * tf + 12 * (75 + 25 * int(lengths[k[1]]) * len(ids) // n)) for k, tf in cells.items()}
        assert treap.most[0][0] == max(impact.values())
        for w in set(word.tolist()):
            top = S.Top(len(ids))
            treap.best(treap.rows(np.array([w], np.uint64)), np.array([1]), top)
            assert dict(zip(top.ids.tolist(), top.scores.tolist())) == {int(ids[c]): v for (x, c), v in impact.items() if x == w}
        assert treap.rows(np.array([1], np.uint64)).tolist() == [-1]


def test_random_texts(spark):
    random.seed(2)
    words = [f"w{i}" for i in range(60)]
    text = lambda n: " ".join(random.choices(words, [1 / (i + 1) for i in range(60)], k=n))
    docs = [(i, text(random.randint(0, 60))) for i in range(300)] + [(7, text(20)), (None, text(30)), (9, None), (10, "..!")]
    docs += [(1000 + i, "w1 w2 w59 same") for i in range(30)]
    items = [(i, text(8)) for i in range(25)] + [(3, "w1 w1 w1 w2"), (3, "w1 w1 w1 w2"), (90, ""), (91, None), (92, "unknown"), (93, "w59 W2 same")]
    items = [(i + 200 if at < 25 else i, t) for at, (i, t) in enumerate(items)]
    want = ranked(docs, items, 20)
    for sizes in ({}, {"range_terms": 40}, {"range_terms": 300, "block_terms": 15}):
        assert run(spark, docs, items, **sizes) == want


def test_opens_few_ranges_for_rare_terms():
    rng = np.random.default_rng(3)
    column = np.repeat(np.arange(2000, dtype=np.int32), 50)
    word = rng.zipf(1.3, len(column)).astype(np.uint64)
    word[column == 777] = np.arange(50).astype(np.uint64) + np.uint64(10**15)
    row = S._grid(np.arange(2000), column, word, len(column), 2000)
    treap = S.Treap.of({c: row[c][0].as_py() for c in row.schema.names})
    top = S.Top(1)
    opened = treap.best(treap.rows(np.arange(50).astype(np.uint64) + np.uint64(10**15)), np.full(50, 7), top)
    assert top.ids.tolist() == [777] and opened < 500


def test_edges(spark):
    assert run(spark, [], [(1, "a")]) == {}
    assert run(spark, [(1, "a b")], []) == {}
    assert run(spark, [(1, None), (2, "")], [(1, "a")]) == {}
    long = "common " * 400_000 + "rare"
    assert run(spark, [(1, long), (2, "common words"), (3, "other")], [(1, "rare"), (2, "COMMON")], k=2) == ranked([(1, long), (2, "common words"), (3, "other")], [(1, "rare"), (2, "COMMON")], 2)
    wide = spark.createDataFrame([(1, "a b", "x", 5)], "doc_id bigint, text string, terms string, n int")
    index, n = S.build_index(wide)
    items = spark.createDataFrame([("one", "b", "y")], "item_id string, text string, rank string")
    assert [tuple(r)[:3] for r in S.search(index, n, items).collect()] == [("one", 1, 1)]
