"""The corpus operators against plain Python, DuckDB and the public libraries, and their edge cases."""

import hashlib
import math
import random
import re
import textwrap
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from oracle import compare
from pyspark.sql import functions as F

import corpus_pipeline
from blockloom.llm import bpe, components, fingerprints, html_extract, language_id, licenses, line_dedup, mixing, ngram_join, quality_divergence, queries, token_counts, words
from blockloom.llm.tables import each_batch, table
from blockloom.session import prepare

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, TEXT string, token string, kept string"
LONG = "word " * 30_000 + "end\n" + "x" * 5_000
EDGE = [
    (1, None, "en", "a", 0, "", "", ""),
    (2, "", "en", "a", 0, "", "", ""),
    (3, " \n\t\n", None, None, 4, "", "", ""),
    (4, "One two three four five six.\nOne two three four five six.", "en", "a", 1, "", "", ""),
    (5, "One two three four five six.\nOne two three four five six.", "en", "a", 1, "", "", ""),
    (5, "One two three four five six.\nOne two three four five six.", "en", "a", 1, "", "", ""),
    (6, LONG, "de", "b", 1, "", "", ""),
    (7, "été ñandú ¿qué?  漢字 \U0001f600 <|endoftext|> x", None, "b", 1, "", "", ""),
    (None, "One two three four five six.", "en", None, 1, "", "", ""),
]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, SCHEMA.replace("TEXT", "text_2")).toDF("doc_id", "text", "lang", "source", "n_chars", "TEXT", "token", "kept")


@pytest.fixture(scope="module")
def docs(spark, folder):
    return table(spark, folder, "documents")


@pytest.fixture(scope="module")
def texts(folder):
    return {r["doc_id"]: r["text"] for r in pq.read_table(f"{folder}/documents.parquet").to_pylist()}


def by_id(df, key="doc_id"):
    rows = df.collect()
    out = {r[key]: r for r in rows}
    assert len(out) == len(rows)
    return out


def test_words_match_plain_python(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(words, "SLICE_BYTES", 64)
    some = ["a B  c", "", None, "ä b\n\tc", "word " * 60, "z" * 400, " x y"]
    known = {}
    for at, hashes, ends in words.word_hashes(pa.array(some), lower=True):
        for i in range(len(ends) - 1):
            own = WORD.findall((some[at + i] or "").translate(LOWER))
            assert len(own) == ends[i + 1] - ends[i]
            assert all(known.setdefault(w, h) == h for w, h in zip(own, hashes[ends[i] : ends[i + 1]]))
    assert len(set(known.values())) == len(known)


def _base(text):
    own = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = Counter(tuple(own[i : i + 3]) for i in range(len(own) - 2))
    covered = {i + k for i in range(len(own) - 2) if windows[tuple(own[i : i + 3])] > 1 for k in range(3)}
    return len(own), sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_quality_base_counts_and_verdict(spark, folder, docs, edge, texts):
    got = by_id(quality_divergence.quality(docs))
    for i, t in texts.items():
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == _base(t)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    judged = [(got[i].kept, q) for i, q in labels.items() if not got[i].base_failed]
    assert sum(k == bool(q) for k, q in judged) >= 0.97 * len(judged)
    rows = quality_divergence.quality(edge).collect()
    for r, (_, t, *_) in zip(sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.n_words)), EDGE):
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == _base(t)
    assert quality_divergence.quality(edge.limit(0)).count() == 0


def test_quality_of_a_language_of_small_share(spark, monkeypatch):
    deal = random.Random(5)
    latin = ["".join(deal.choices("abcdefgh", k=5)) for _ in range(80)]
    greek = ["".join(deal.choices("αβγδεζηθ", k=5)) for _ in range(80)]
    text = lambda of, n: " ".join(deal.choices(of, k=n))
    rows = [(i, text(latin, 3000), "la") for i in range(900)] + [(i, text(greek, 250), "el") for i in range(900, 908)] + [(908, text(greek, 250), "la"), (909, text(greek, 250), None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert 8 * 250 < 0.001 * 900 * 3000
    got = by_id(quality_divergence.quality(docs))
    assert all(got[i].kept == (i < 908) for i in range(len(rows)))
    for held, broadcast in ((1, 100), (1, 0), (0, 100)):
        monkeypatch.setattr(quality_divergence, "BROADCAST_REFERENCES", broadcast)
        assert by_id(quality_divergence.quality(docs, held=held)) == got


def test_quality_below_the_reference_minimum_is_not_judged(spark):
    deal = random.Random(6)
    words = {k: ["".join(deal.choices(a, k=5)) for _ in range(80)] for k, a in (("la", "abcdefgh"), ("el", "αβγδεζηθ"))}
    rows = [(i, " ".join(deal.choices(words["la"], k=300)), "la") for i in range(200)] + [(i, " ".join(deal.choices(words["el"], k=300)), "el") for i in range(200, 203)]
    rows += [(203, "αβγ", "el"), (204, " ".join(deal.choices(words["el"], k=300)), "unknown"), (205, None, "el"), (206, " ".join(deal.choices(words["el"], k=300)), None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = by_id(quality_divergence.quality(docs))
    assert all(got[i].kept and got[i].char_distance is not None for i in range(200))
    for i in (200, 201, 202, 204):  # 903 words of the language, 300 of another
        assert got[i].kept and got[i].char_distance is None and got[i].word_distance is None
    assert not got[203].kept and not got[205].kept and not got[206].kept and got[206].char_distance > 0.5
    few = by_id(quality_divergence.quality(docs.where("doc_id in (0, 206)")))  # no reference of 1,000 words at all
    assert few[0].kept and few[206].kept and few[206].word_distance is None


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_queries_with_sql(spark, folder, name):
    assert compare(queries.QUERIES[name](spark, folder), queries.ORACLES[name], folder) is None


def test_mixing_meets_margins_and_handles_edges(docs, edge):
    rows = mixing.mix(docs).select("source", "lang", "topic", "n_tokens", "probability").collect()
    total = sum(r.n_tokens for r in rows)
    assert abs(sum(r.n_tokens * r.probability for r in rows) - total / 2) < 0.01 * total
    out = mixing.mix(edge)
    assert out.count() == len(EDGE) and out.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    assert mixing.mix(edge.limit(0)).count() == 0


def _cells(spark, rows):
    return spark.createDataFrame(rows, "source string, lang string, topic string, tokens bigint")


def test_raking_meets_every_margin(spark, monkeypatch):
    tokens = {"a": 90_000, "b": 4_000, "c": 600}
    rows = [(s, x, t, tokens[s] // (1 + 2 * i + j)) for s in tokens for i, x in enumerate(("en", "de")) for j, t in enumerate(("prose", "table"))]
    errors = {(r.margin, r.value): r for r in mixing.margin_errors(mixing.rake(_cells(spark, rows))).collect()}
    assert len(errors) == 7 and all(abs(r.error) < 0.01 for r in errors.values())
    for m in mixing.MARGINS:
        assert abs(sum(r.target for (x, _), r in errors.items() if x == m) - sum(r[3] for r in rows) / 2) < 1
    # a value that has less than its share gives all, and the others of its margin take over
    assert errors["source", "c"].target == errors["source", "c"].tokens
    monkeypatch.setattr(mixing, "ONE_TASK_CELLS", 0)
    shuffled = {(r.margin, r.value): r.reached for r in mixing.margin_errors(mixing.rake(_cells(spark, rows))).collect()}
    assert all(abs(shuffled[k] - r.reached) < 1e-6 * r.reached for k, r in errors.items())


def test_raking_to_given_targets_and_errors_out_of_reach(spark):
    rows = [("a", "en", "x", 1000), ("a", "de", "x", 1000), ("b", "en", "x", 1000)]
    wanted = spark.createDataFrame([("source", "a", 700.0), ("source", "b", 300.0), ("lang", "de", 200.0), ("lang", "en", 800.0), ("topic", "x", 1000.0)], "margin string, value string, target double")
    raked = mixing.rake(_cells(spark, rows), targets=wanted)
    assert {(r.source, r.lang): round(r.weight) for r in raked.collect()} == {("a", "en"): 500, ("a", "de"): 200, ("b", "en"): 300}
    # b is wholly English: these margins contradict each other, which the report tells
    clash = spark.createDataFrame([("source", "b", 900.0), ("source", "a", 100.0), ("lang", "en", 100.0), ("lang", "de", 900.0), ("topic", "x", 1000.0)], wanted.schema)
    errors = {(r.margin, r.value): r.error for r in mixing.margin_errors(mixing.rake(_cells(spark, rows), targets=clash)).collect()}
    assert max(abs(e) for e in errors.values()) > 0.1


def test_licenses_by_line_and_inheritance(spark, edge):
    rows = [
        (1, "p/LICENSE", "Released under the MIT License."),
        (2, "p/a/b/x.py", "code here"),
        (3, "p/a/y.py", "# Licensed under the Apache License, Version 2.0.\nmore code"),
        (4, "q/z.py", "nothing to see"),
        (5, None, "All rights reserved."),
        (6, "p/q/LICENSE.txt", None),
        (7, "p/q/w.py", ""),
    ]
    filler = [(100 + i, f"other/{i}.txt", f"the and of to license work under {i} reserved for all") for i in range(50)]
    got = by_id(licenses.scan_licenses(spark.createDataFrame(rows + filler, "doc_id bigint, path string, text string")))
    assert [got[i].license for i in range(1, 8)] == ["MIT", "MIT", "Apache-2.0", None, "proprietary", "MIT", "MIT"]
    assert got[2].inherited_from == "p" and got[3].inherited_from is None and got[3].line == 0
    assert licenses.scan_licenses(edge.withColumnRenamed("token", "path")).count() == len(EDGE)


def test_licenses_wrapped_over_lines(spark, monkeypatch):
    def wrapped(text, width, mark="", top="", end="code here\nmore code\n" * 30):
        return top + "".join(f"{mark}{x}\n" for x in textwrap.wrap(text, width)) + end

    sentence = licenses.TEMPLATES["GPL-3.0"][1]
    cases = []
    for name, texts in licenses.NOTICES.items():
        cases += [(name, wrapped(texts[0], 70, " * ", "/*\n * Copyright (C) 2020 Some Body.\n * All rights reserved.\n *\n")), (name, wrapped(texts[-1], 58, "# ", "x = 1\n" * 300))]
    cases += [("GPL-3.0", wrapped(sentence, 60, "// ")), ("MPL-2.0", wrapped(licenses.TEMPLATES["MPL-2.0"][0], 30, "; ")), (None, "code here\nnothing to see\n" * 50)]
    rows = [(i, f"d{i}/x.py", text) for i, (_, text) in enumerate(cases)]
    rows += [(50, "gnu/COPYING", wrapped(licenses.NOTICES["GPL-2.0"][1], 70, "   ", end="terms of the license and conditions for all\n" * 200))]
    filler = [(100 + i, f"other/{i}.txt", f"the and of to license work under {i} reserved for all") for i in range(300)]
    docs = spark.createDataFrame(rows + filler, "doc_id bigint, path string, text string")
    got = by_id(licenses.scan_licenses(docs))
    assert [got[i].own_license for i in range(len(cases))] == [name for name, _ in cases]
    assert got[50].own_license == "GPL-2.0" and got[1].line == 300
    # a notice over the edge of two parts of a long text
    long = "plain words here\n" * 600
    for at in range(0, 30, 3):
        text = "x\n" * at + long[: 2 * 17 * 60] + wrapped(sentence, 40, "# ", end=long)
        scanner = licenses.Scanner(np.zeros(1 << 18, np.int64), 1000, (licenses.NOTICES, licenses.TEMPLATES), licenses.MIN_COSINE)
        batch = pa.RecordBatch.from_pydict({"id": [1], "path": ["a"], "license_file": [False], "text": [text]})
        one = scanner.scan(batch).to_pylist()[0]
        with monkeypatch.context() as m:
            m.setattr(licenses, "SLICE_BYTES", 512)
            m.setattr(words, "SLICE_BYTES", 512)
            assert scanner.scan(batch).to_pylist()[0] == one and one["own_license"] == "GPL-3.0" and one["line"] == at + 120


def test_bpe_is_the_librarys_and_round_trips(docs, edge, texts):
    ranks = bpe.ranks_of(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    own = bpe.encoder(ranks, public_tokenizers.PATTERN)
    for chunk, overlap in ((bpe.CHUNK, bpe.OVERLAP), (400, 60)):
        got = by_id(bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN, chunk=chunk, overlap=overlap), ranks))
        for i, t in texts.items():
            assert list(got[i].ids) == own.encode_ordinary(t) and bytes(got[i].decoded) == t.encode()
    rows = bpe.decode(bpe.encode(edge, ranks, public_tokenizers.PATTERN, chunk=400, overlap=60), ranks).collect()
    assert sorted(bytes(r.decoded) for r in rows) == sorted((t or "").encode() for _, t, *_ in EDGE)
    assert bpe.encode(edge.limit(0), ranks, public_tokenizers.PATTERN).count() == 0


def test_pipeline_hands_python_batches_of_few_megabytes(spark):
    prepare(spark)  # a thousand chunks of a long text would make one batch of 24 MB, held by the JVM and by the worker
    rows = spark.range(0, 600, 1, 1).select(F.repeat(F.lit("word cut "), bpe.CHUNK // 9).alias("text"))
    sizes = rows.mapInArrow(each_batch(lambda b: pa.RecordBatch.from_pydict({"rows": [b.num_rows], "size": [b.nbytes]})), "rows bigint, size bigint").collect()
    assert sum(r["rows"] for r in sizes) == 600 and max(r["size"] for r in sizes) < 5_000_000


def test_decoding_joins_the_bytes_of_each_id(spark):
    ranks = bpe.ranks_of(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    words = {rank: word for word, rank in bpe._table(ranks).items()}
    lists = [[], None, [0], [300, 255, 300], sorted(words)[-3:], list(range(0, 3000, 7))]
    rows = spark.createDataFrame(list(enumerate(lists)), "id int, ids array<int>").coalesce(1)
    got = {r["id"]: bytes(r["decoded"]) for r in bpe.decode(rows, ranks).collect()}
    assert got == {i: b"".join(words[x] for x in ids or ()) for i, ids in enumerate(lists)}


def test_fingerprints(spark, docs, edge, texts):
    got = by_id(fingerprints.compare_edited(docs))
    ids = sorted(texts)
    for i, j in zip(ids, ids[1:] + ids[:1]):
        a, b = texts[i], texts[j]
        k = len(a) // 4
        assert got[i].n_chars == len(a) and got[i].edited_sha256 == hashlib.sha256((a[: len(a) - k] + b[:k]).encode()).hexdigest()
        assert got[i].near_next == pytest.approx(fingerprints.likeness(got[i].fingerprint, got[j].fingerprint))
    assert len({r.fingerprint for r in got.values()}) == len(set(texts.values()))
    long = [r for r in got.values() if r.n_chars > 2000]
    assert sum(r.near_edited for r in long) / len(long) > 0.6 > 0.2 > sum(r.near_next for r in long) / len(long)
    parts = spark.createDataFrame([(1, "a b\nc d\nx"), (2, "x\na b\nc d"), (3, "a b\nc d"), (4, "x"), (5, "")], "doc_id bigint, text string")
    one = {i: r.fingerprint for i, r in by_id(fingerprints.fingerprint(parts)).items()}
    assert one[1] == one[2] == fingerprints.add(one[3], one[4]) and fingerprints.add(one[1], one[4], -1) == one[3] != one[1]
    assert fingerprints.compare_edited(edge).count() == len(EDGE) and fingerprints.compare_edited(edge.limit(0)).count() == 0


def test_html_text(spark, folder):
    pages = table(spark, folder, "pages")
    got = by_id(html_extract.extract(pages), "page_id")
    import html

    for r in pages.collect():  # the article of these pages is marked; the labels of half of them were not seen
        article = re.search(r"<article>(.*?)</article>", r.html, re.S).group(1)
        parts = [" ".join(html.unescape(re.sub(r"<br>|</?b>", lambda m: " " if m.group() == "<br>" else "", p)).split()) for p in re.split(r"</?(?:p|h1)>", article)]
        assert got[r.page_id].text == "\n".join(p for p in parts if p) and got[r.page_id].n_chars == len(got[r.page_id].text)
    odd = ["", None, "<p>a<p>b<!-- open <p>c", '<body><main><h1>A</h1><p>One two, three. Four.</p></main><div class="comments"><p>Nice text, thanks.</p></div></body>', "<" * 2000, "<a href='x" * 500]
    rows = by_id(html_extract.extract(spark.createDataFrame([(i, "u", h) for i, h in enumerate(odd)], "page_id bigint, url string, html string"), html_extract.fit(pages)), "page_id")
    assert rows[0].text == rows[1].text == "" and rows[2].text == "a\nb" and rows[3].text == "A\nOne two, three. Four."


@pytest.mark.parametrize("holder", ['<div class="post-body">', "<div>"])
def test_html_without_semantic_tags(spark, folder, holder):
    """No page has an article or main tag: labels come from attributes, or from the share of links."""
    pages = table(spark, folder, "pages")
    bare = pages.withColumn("html", F.regexp_replace(F.regexp_replace("html", "<(article|main)[^>]*>", holder), "</(article|main)>", "</div>"))
    assert bare.where(F.lower("html").rlike("<(article|main)")).count() == 0
    want, got = by_id(html_extract.extract(pages), "page_id"), by_id(html_extract.extract(bare), "page_id")
    assert sum(got[i].text == want[i].text for i in want) >= 0.95 * len(want)


def test_html_of_one_page_without_semantic_tags(spark):
    page = '<body><div class="menu"><a href="/">Home</a> <a href="/n">News</a></div><div{}><h1>Title</h1><p>Some text, with a <a href="/x">link</a> in it.</p><p>More of it.</p></div>'
    page += '<div class="comments"><p>nice post</p></div><div id="footer"><p>Copyright 2020</p></div></body>'
    for name in (' class="entry"', ""):
        rows = [(i, "u", page.format(name)) for i in range(3)] + [(3, "u", None), (4, "u", "")]
        got = by_id(html_extract.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")), "page_id")
        assert all(got[i].text == "Title\nSome text, with a link in it.\nMore of it." for i in range(3)) and got[3].text == got[4].text == ""
    nothing = spark.createDataFrame([(1, "u", "<p>a</p>")], "page_id bigint, url string, html string")
    assert html_extract.extract(nothing).first().text == "a" and html_extract.extract(nothing.limit(0)).count() == 0


def test_language(spark, docs, edge):
    rows = language_id.identify(docs).select("lang", "language", "kept").collect()
    assert sum(r.lang == r.language for r in rows) >= 0.97 * len(rows) and sum(r.kept for r in rows) >= 0.99 * len(rows)
    model = language_id.Model.fit(docs)
    blind = language_id.identify(docs, model, declared=None, host=None).select("lang", "language").collect()
    assert sum(r.lang == r.language for r in blind) >= 0.95 * len(blind)
    url = docs.withColumn("url", F.concat(F.lit("https://www.x."), "lang", F.lit("/a?b")))
    assert language_id.identify(url, model, declared=None, host=None, url="url").where("lang = language").count() >= 0.97 * len(rows)
    out = language_id.identify(edge, model).collect()
    assert len(out) == len(EDGE) and not any(r.kept for r in out if not r.text)
    assert language_id.identify(edge.limit(0)).count() == 0


def test_language_of_pages(spark, folder):
    pages = table(spark, folder, "pages")
    # the address of a test page names its language, which nothing here reads: it has to follow from text, markup, host and suffix
    named = pages.select("page_id", F.regexp_extract("url", "//[^/]+/([a-z]{2})/", 1).alias("truth"))
    wrong = F.when(F.col("page_id") % 10 == 3, F.regexp_replace("html", '<html lang="[a-z]+"', '<HTML class=x LANG=fr-CA')).otherwise(F.col("html"))
    rows = language_id.identify_pages(pages.withColumn("html", wrong)).join(named, "page_id").collect()
    assert len(rows) == pages.count() and sum(r.language == r.truth for r in rows) >= 0.95 * len(rows)
    assert all(r.declared == ("fr" if r.page_id % 10 == 3 else r.truth) for r in rows)
    assert language_id.identify_pages(pages.limit(0)).count() == 0
    odd = [(1, None, None), (2, "", ""), (None, "x", "<html lang='de"), (2, "", ""), (3, "http://a.b.fr/", '<!-- x --><html xml:lang="en" lang = "pt-BR"><body><p>um texto curto')]
    data = spark.createDataFrame([(*r, "mine") for r in odd], "page_id bigint, url string, html string, kept string")
    got = language_id.identify_pages(data).collect()
    assert sorted((r.page_id or 0, r.declared, r.kept) for r in got)[1:3] == [(1, None, False), (2, None, False)]
    assert len(got) == 5 and [r.declared for r in got if r.page_id == 3] == ["pt"]


def test_posterior_is_plain_bayes(spark, docs):
    """The posterior of whole documents against the formula in plain Python, from the model's shares and counted evidence."""
    rows = docs.where("n_chars BETWEEN 10 AND 400").orderBy("doc_id").limit(40).select("doc_id", "text", "lang", "source").persist()
    model, data = language_id.Model.fit(docs), rows.collect()
    names, few, places = model.languages, len(model.languages), range(len(model.languages) + 1)
    logs = [*model.logs, model.other]

    def text_only(text):
        blob = np.frombuffer((text or "").encode(), np.uint8)
        cells = language_id._cells(blob) if len(blob) >= 3 else []
        return [sum(float(x[c]) for c in cells) * min(1, language_id.WEIGHT / max(len(cells), 1)) for x in logs], len(cells)

    counts = Counter()
    for r in data:
        scores, grams = text_only(r.text)
        best = max(places, key=lambda j: (scores[j], -j))
        if grams and best < few:
            counts[r.source, r.lang, best] += 1
    total = [1 + sum(n for (*_, b), n in counts.items() if b == j) for j in range(few)]
    made = len({d for _, d, _ in counts if d})
    got = {r.doc_id: r for r in language_id.identify(rows, model).collect()}
    for r in data:
        scores, grams = text_only(r.text)
        up = [t / sum(total) for t in total]
        for key in (lambda s: True, lambda s: s == r.source):  # the suffix of all sources is empty, so the first is all hosts
            own = [sum(n for (s, _, b), n in counts.items() if b == j and key(s)) for j in range(few)]
            up = [(x + language_id.STRENGTH * p) / (sum(own) + language_id.STRENGTH) for x, p in zip(own, up)] if sum(own) else up
        said = [sum(n for (_, d, b), n in counts.items() if b == j and d == r.lang) for j in range(few)]
        if r.lang and sum(said):
            scores = [s + math.log((x + 1) / (t + made)) for s, x, t in zip(scores, said, total)] + [scores[-1] + math.log((sum(said) + 1) / (sum(total) + made))]
        scores = [s + math.log(p) + math.log(1 - language_id.OTHER) for s, p in zip(scores, up)] + [scores[-1] + math.log(language_id.OTHER)]
        odds = [math.exp(s - max(scores)) for s in scores]
        best = max(range(few), key=lambda j: (odds[j], -j))
        g = got[r.doc_id]
        assert g.language == names[best] and g.posterior == pytest.approx(odds[best] / sum(odds), rel=1e-6) and g.n_trigrams == grams


def test_language_of_small_share_and_outside_the_model(spark, docs, texts):
    for small in ("de", "es"):
        rare = docs.where(F.col("lang") == small).orderBy("doc_id").limit(4)
        skewed = docs.where("lang = 'en' AND n_chars > 100").unionByName(rare.where("n_chars > 100"))
        model = language_id.Model.fit(skewed, sample=60)
        assert model.languages == sorted([small, "en"])
        got = language_id.identify(skewed, model).collect()
        assert sum(r.lang == r.language and r.kept for r in got) >= 0.95 * len(got) and all(r.language == small for r in got if r.lang == small)
        known = language_id.Model.fit(docs.where(F.col("lang") != small))
        assert small not in known.languages
        blind = language_id.identify(docs.where("n_chars > 300"), known, declared=None, host=None).select("lang", "language", "kept").collect()
        strange = [r.kept for r in blind if r.lang == small]
        assert sum(strange) <= 0.1 * len(strange) and sum(r.kept for r in blind if r.lang != small) >= 0.97 * (len(blind) - len(strange))
    one = spark.createDataFrame([(None, "one text of a language", "xx")] * 50, "doc_id bigint, text string, lang string")
    assert language_id.Model.fit(one, sample=3).languages == ["xx"]


def test_language_evidence_of_every_declaration(spark):
    rows = [("h", "", f"d{i}", i % 2, 3 + i) for i in range(1200)]
    _, declared, overall = language_id._evidence(spark.createDataFrame(rows, "host string, suffix string, declared string, best int, n bigint"), 2, 20.0)
    got = {r.declared: r.said for r in declared.collect()}
    total = [1 + sum(n for *_, b, n in rows if b == j) for j in (0, 1)]
    assert len(got) == 1200 and overall == pytest.approx([t / sum(total) for t in total])
    assert got["d0"] == pytest.approx([math.log(4 / (total[0] + 1200)), math.log(1 / (total[1] + 1200)), math.log(4 / (sum(total) + 1200))])


def test_line_dedup_edges(spark, edge):
    out = line_dedup.dedup_lines(edge)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "TEXT", "token", "kept", "n_lines", "n_removed"]
    rows = [tuple(r) for r in out.collect()]
    got = {r[0]: (r[1], r[-2], r[-1]) for r in rows}
    assert len(rows) == len(EDGE) and got[1] == (None, 0, 0) and got[2] == ("", 1, 0) and got[3] == (" \n\t\n", 3, 0)
    assert got[None] == ("One two three four five six.", 1, 0) and got[4] == ("", 2, 2) and got[5] == ("", 2, 2)  # null ids come first
    assert line_dedup.dedup_lines(edge.limit(0)).count() == 0


@pytest.mark.parametrize("token_rows", [50_000, 20])
def test_line_dedup_is_brute_force(spark, monkeypatch, token_rows):
    """Families of near lines over few words, so that tokens are of many classes; a low limit deals tokens over tasks."""
    monkeypatch.setattr(line_dedup, "TOKEN_ROWS", token_rows)
    draw = random.Random(7)
    bases = [[f"w{draw.randrange(60)}" for _ in range(draw.randint(12, 40))] for _ in range(12)]

    def line():
        own = list(draw.choice(bases))
        for _ in range(draw.randint(0, 3)):
            own[draw.randrange(len(own))] = f"w{draw.randrange(60)}"
        return draw.choice([" ", "\t", "  "]).join(own[: draw.randint(len(own) - 2, len(own))])

    texts = {i: "\n".join([line() for _ in range(4)] + [""]) for i in range(60)}
    seen, expected = [], {}
    for i, t in texts.items():
        stay = []
        for own in t.split("\n"):
            words = set(own.split())
            if not words or not any(100 * len(words & w) >= 90 * len(words | w) for w in seen):
                stay.append(own)
            if words:
                seen.append(words)
        expected[i] = "\n".join(stay)
    got = line_dedup.dedup_lines(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string"))
    assert {r.doc_id: r.text for r in got.collect()} == expected


def _groups(texts, percent=75, size=5):
    sets = {}
    for i, t in texts.items():
        own = WORD.findall((t or "").translate(LOWER))
        sets[i] = {tuple(own[k : k + size]) for k in range(max(1, len(own) - size + 1))} if own else set()
    holders = {}
    for i, s in sets.items():
        for g in s:
            holders.setdefault(g, []).append(i)
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, s in sets.items():
        for j, k in Counter(j for g in s for j in holders[g] if j > i).items():
            if 100 * k >= percent * (len(s) + len(sets[j]) - k):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def test_ngram_join(spark, docs, edge, texts):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similar_documents(docs).collect()}
    assert got == _groups(texts)
    rng = random.Random(3)
    base = [f"w{k}" for k in range(60)]
    near = {}
    for i in range(150):  # a chain of near copies around one text, and passages that many share
        own = list(base)
        for _ in range(rng.randint(0, 6)):
            own[rng.randrange(60)] = f"e{rng.randrange(400)}"
        near[i] = " ".join(own) if i % 3 else " ".join(own[:30] + [f"u{i}_{k}" for k in range(rng.randint(3, 60))])
    near |= {200: None, 201: "", 202: "a b", 203: "A B", 204: "a b c"}
    df = spark.createDataFrame(list(near.items()), "doc_id bigint, text string")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similar_documents(df).collect()} == _groups(near)
    rows = ngram_join.similar_documents(edge).collect()
    assert len(rows) == len(EDGE) and {r.component_id for r in rows if r.doc_id in (4, 5)} == {4}
    kept = ngram_join.one_of_each(edge)
    assert kept.columns == edge.columns and Counter(r[0] for r in kept.collect()) == Counter([1, 2, 3, 4, 6, 7, None])
    assert ngram_join.similar_documents(edge.limit(0)).count() == 0


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (5, 5)], "a bigint, b bigint")
    want = {**{i: 0 for i in range(301)}, 1000: 1000, 1001: 1000}
    for one_task in (0, 40, 1000):  # contracted to the end, down to 40 links, not at all
        assert {r.node: r.root for r in components.components(links, one_task).collect()} == want


def test_components_of_random_links(spark):
    rng = random.Random(8)
    pairs = [(rng.randrange(-500, 500), rng.randrange(-500, 500)) for _ in range(600)]
    least = {n: n for p in pairs for n in p}
    for _ in range(len(least)):
        before = dict(least)
        for a, b in pairs:
            least[a] = least[b] = min(least[a], least[b])
        if before == least:
            break
    linked = {n for a, b in pairs if a != b for n in (a, b)}
    links = spark.createDataFrame(pairs, "a bigint, b bigint")
    for one_task in (0, 100, 1000):
        assert {r.node: r.root for r in components.components(links, one_task).collect()} == {n: least[n] for n in linked}


def test_token_counts_of_every_prefix(spark, docs, edge, texts):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    count = lambda s: len(library.encode(s, add_special_tokens=False).ids)
    got = by_id(token_counts.token_counts(docs, path))
    assert all(got[i].n_tokens == count(t) and got[i].n_bytes == len(t.encode()) for i, t in texts.items())
    rng = random.Random(5)
    some = ["  hello   world\n\n x  'll we're <|endoftext|> yes<|endoftext|>", "a" * 40 + "  \t b", "日本 混在 — “q” a\x85b\xa0 c", "it'll 'LL 's'sand <|end"]
    some += ["".join(rng.choice("ab 'lr\n\t.!9é<|>— 漢") for _ in range(rng.randint(0, 30))) for _ in range(60)]
    df = token_counts.token_counts(spark.createDataFrame(list(enumerate(some)), "doc_id bigint, text string"), path)
    for i, r in by_id(df).items():
        steps = token_counts.prefix_table(r.steps)
        assert steps.tolist() == [count(some[i][:k]) for k in range(len(some[i]) + 1)]
    assert all(r.tokens_at == count(some[i][:7]) for i, r in by_id(token_counts.counts_at(df, 7)).items())
    assert all(count(some[i][: r.chars_within]) <= 5 for i, r in by_id(token_counts.chars_within(df, 5)).items())
    assert token_counts.token_counts(edge, path).count() == len(EDGE)


def test_pipeline_against_its_parts(spark, folder, docs, texts):
    names = docs.columns
    kept = {r[0]: r for r in corpus_pipeline.identify_language(spark, docs, folder).collect()}
    assert len(kept) >= 0.99 * len(texts)
    path = f"{folder}"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet'")
    lines = corpus_pipeline.dedup_lines(spark, docs, folder)
    assert lines.columns == names
    expected = {i: t for i, n, gone, t in con.execute(line_dedup.oracle()).fetchall() if not (gone and not WORD.search(t))}
    got = {r.doc_id: r.text for r in lines.collect()}
    assert got == expected and all(r.n_chars == len(r.text) for r in lines.collect())
    groups = _groups(texts)
    assert {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, folder).collect()} == {i for i, (_, c) in groups.items() if c == i}
    mixed = {r[0] for r in con.execute(mixing.oracle(keep=True)).fetchall()}
    assert {r.doc_id for r in corpus_pipeline.mix_sources(spark, docs, folder).collect()} == mixed
    out = corpus_pipeline.run(spark, folder).collect()
    assert 0 < len(out) < len(texts) and all(r.n_tokens == len(r.ids) for r in out)


def test_pipeline_carries_further_columns_and_odd_rows(spark, docs):
    """Columns named as the operators name theirs, in every stage but the last; nulls, empty and repeated rows."""
    plain = ["doc_id", "text", "lang", "source", "n_chars"]
    odd = spark.createDataFrame([r[:5] for r in EDGE], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    odd = odd.withColumn("doc_id", F.col("doc_id") + 1_000_000)
    names = ["kept", "language", "posterior", "topic", "probability", "n_tokens", "n_lines", "n_removed", "component_id", "TEXT"]
    rows = docs.select(*plain).unionByName(odd)
    now = rows.select(*plain, *[F.concat(F.lit(f"{n} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).alias(f"x{i}") for i, n in enumerate(names)]).toDF(*plain, *names)
    left = rows.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, now, "")
        assert out.columns == now.columns
        held = out.toDF(*plain, *[f"x{i}" for i in range(len(names))]).persist()
        got = held.collect()
        assert 0 < len(got) <= left
        for r in got:
            assert [r[f"x{i}"] for i in range(len(names))] == [f"{n} of {'null' if r.doc_id is None else r.doc_id}" for n in names]
        left, now = len(got), held.toDF(*plain, *names)
    last = corpus_pipeline.STAGES[-1][1](spark, now, "")
    assert last.columns == ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"] and last.count() == left


def test_pipeline_of_an_empty_table(spark, docs, tmp_path):
    docs.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
