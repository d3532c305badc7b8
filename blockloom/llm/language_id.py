"""Language identification by Bayesian evidence fusion.

For language l the posterior is, up to a factor, ``p(l | host) * p(declared | l) * exp(tempered text log-likelihood)``:

- the text model holds shares of byte trigrams (in ``CELLS`` cells of a hash) by language, trained for each declared
  language on its documents with the least hashes of their id: all of them up to ``SAMPLE``, about as many beyond.  So
  every language that documents with a trigram declare has a model, however small its share;
- a text may be of a language outside the model, with a prior of ``OTHER``: its trigrams are then dealt half as in the
  mean of all languages and half evenly, which is likelier than any language as soon as much of the text is strange to all;
- the log-likelihood of a text is tempered to that of ``WEIGHT`` trigrams, so that text, of which neighbouring trigrams
  tell much the same, doesn't drown the other evidence;
- ``p(declared | l)`` comes from counts of declared against text-only decisions over all documents, and so learns how far
  declarations can be trusted, each declaration by a table joined to the documents; outside the model declarations are
  as frequent as overall; a missing declaration is no evidence.  Text-only decisions for no language are not counted;
- host priors are counts of text-only decisions, smoothed to the host's address suffix and that to all documents, each
  with ``STRENGTH`` imagined documents.  They come from one grouped aggregation with partial sums, so a host with a third
  of all rows costs no more than others, and reach the documents by a join of checked size.

A document is rejected if it has no trigram (null, empty, one or two bytes) or if no language reaches ``MIN_POSTERIOR``
of the posterior, of which what lies outside the model has its part; the language then is only the likeliest of the model.
Ties between languages go to the first by name.  A null or unknown declaration or host counts as missing.

:func:`identify_pages` does this for web pages, whose markup declares the language and whose address gives host and suffix.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockloom.llm.tables import Carried, each_batch, join_small, pick, stored
from blockloom.llm.words import _LOWER_CODE, mix, raw, slices

BITS = 13
CELLS = 1 << BITS
SAMPLE = 4000
#: Imagined trigrams with the shares of all languages together, added to each one's own.
SMOOTHING = 4000.0
WEIGHT = 60.0
STRENGTH = 20.0
MIN_POSTERIOR = 0.5
OTHER = 0.01
PIECE = 1 << 18


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))


def suffix_of(host: Column) -> Column:
    """The last label of a host's address; empty if it has a single label."""
    return F.regexp_extract(host, r"\.([^.]+)$", 1)


def markup_language(html: Column) -> Column:
    """Primary tag of the language that the html element declares, in lower case; null without one."""
    said = F.regexp_extract(html, r"""(?is)<html(?=[\s>])[^>]*?\slang\s*=\s*["']?\s*([a-z]{2,8})(?![a-z])""", 1)
    return F.when(said != "", F.lower(said))


def _cells(data: np.ndarray) -> np.ndarray:
    code = _LOWER_CODE[data]
    return (mix(code[:-2] + mix(code[1:-1] + mix(code[2:]))) >> np.uint64(64 - BITS)).astype(np.int64)


def _trigrams(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Pieces of texts: number of the first text, owner of each trigram counted from it, and its cell."""
    data, offsets = raw(column)
    for at, to in slices(offsets):
        own = offsets[at : to + 1]
        for a in range(int(own[0]), int(own[-1]), PIECE):
            part = data[a : min(a + PIECE + 2, int(own[-1]))]
            if len(part) >= 3:
                places = np.arange(a, a + len(part) - 2)
                owner = np.searchsorted(own, places, "right") - 1
                whole = own[owner + 1] >= places + 3
                yield at, owner[whole], _cells(part)[whole]


def _trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch["lang"].to_pylist()
        for at, owner, cells in _trigrams(batch["text"]):
            for i in np.unique(owner):
                got = np.bincount(cells[owner == i], minlength=CELLS)
                name = langs[at + i]
                held[name] = held[name] + got if name in held else got
        if len(held) > 256:
            yield _counts(held)
            held.clear()
    if held:
        yield _counts(held)


def _counts(held: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"lang": pa.array(list(held), pa.string()), "counts": pa.array([v.astype(np.int64).tobytes() for v in held.values()], pa.binary())})


def _sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, np.ndarray] = {}
    for batch in batches:
        for k, blob in zip(batch["lang"].to_pylist(), batch["counts"].to_pylist()):
            got = np.frombuffer(blob, np.int64)
            held[k] = held[k] + got if k in held else got
    if held:
        yield _counts(held)


class Model:
    """Log shares of the trigram cells by language, fitted on a bounded sample of each, and outside all of them."""

    def __init__(self, languages: list[str], logs: np.ndarray):
        self.languages, self.logs = languages, logs
        self.other = np.log(0.5 / CELLS + np.exp(logs).sum(axis=0) / (2 * max(len(languages), 1)))

    @staticmethod
    def fit(docs: DataFrame, id: str = "doc_id", text: str = "text", declared: str = "lang", sample: int = SAMPLE) -> Model:
        rows = pick(docs, id=id, text=text, lang=declared).select(F.col("lang").cast("string"), F.col("text").cast("string"), F.xxhash64("id").alias("h"))
        rows = rows.where("lang <> '' AND octet_length(text) >= 3")
        # hashes are even over 64 bits, so a share of them is that share of the documents; the least is always in, whatever repeats
        bounds = rows.groupBy("lang").agg(F.count("*").alias("n"), F.min("h").alias("least"))
        share = (F.lit(-(2.0**63)) + F.lit(2.0**64) * sample / F.col("n")).cast("bigint")
        bounds = bounds.select("lang", F.when(F.col("n") <= sample, F.lit((1 << 63) - 1)).otherwise(F.greatest("least", share)).alias("bound"))
        chosen = join_small(rows, bounds, "lang").where("h <= bound").select("lang", "text")
        schema = "lang string, counts binary"
        sums = {}
        for r in chosen.mapInArrow(_trained, schema).repartition("lang").mapInArrow(_sum, schema).toLocalIterator():  # one row a language
            sums[r["lang"]] = np.frombuffer(r["counts"], np.int64)
        languages = sorted(sums)
        if not languages:
            return Model([], np.zeros((0, CELLS)))
        counts = np.array([sums[k] for k in languages], float)
        pooled = counts.sum(axis=0) + 0.5
        counts += SMOOTHING * pooled / pooled.sum()
        return Model(languages, np.log(counts / counts.sum(axis=1, keepdims=True)))

    def scores(self, column: pa.Array, weight: float) -> tuple[np.ndarray, np.ndarray]:
        """Tempered log-likelihoods (texts x languages, and outside the model last) and the number of trigrams of each text."""
        n, logs = len(column), [*self.logs, self.other]
        total, grams = np.zeros((n, len(logs))), np.zeros(n, np.int64)
        for at, owner, cells in _trigrams(column):
            if not len(owner):
                continue
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            who = at + owner[starts]
            grams[who] += np.diff(np.append(starts, len(owner)))
            for j, shares in enumerate(logs):
                total[who, j] += np.add.reduceat(shares[cells], starts)
        return total * np.minimum(1, weight / np.maximum(grams, 1))[:, None], grams


def _text_only(model: Model, weight: float):
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores, grams = model.scores(batch["text"], weight)
        best = scores.argmax(axis=1)
        told = (grams > 0) & (best < len(model.languages))
        return pa.RecordBatch.from_pydict(
            {"host": batch["host"], "suffix": batch["suffix"], "declared": batch["declared"], "best": pa.array(np.where(told, best, -1), pa.int32())},
        )

    return each_batch(work)


def _fused(model: Model, weight: float, overall: np.ndarray, least: float):
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores, grams = model.scores(batch["text"], weight)
        none = np.zeros(len(model.languages) + 1)
        prior = np.array([overall if p is None else p for p in batch["prior"].to_pylist()]).reshape(len(grams), -1)
        said = np.array([none if d is None else d for d in batch["said"].to_pylist()]).reshape(len(grams), -1)
        scores = scores + said
        scores[:, :-1] += np.log(prior) + np.log(1 - OTHER)
        scores[:, -1] += np.log(OTHER)
        scores -= scores.max(axis=1, keepdims=True)
        odds = np.exp(scores)
        odds /= odds.sum(axis=1, keepdims=True)
        best = odds[:, :-1].argmax(axis=1)
        top = odds[np.arange(len(best)), best]
        kept = (grams > 0) & (top >= least)
        names = pa.array(model.languages, pa.string()).take(pa.array(best, pa.int64()))
        out = {c: batch[c] for c in batch.schema.names if c.startswith("_c")}
        return pa.RecordBatch.from_pydict({**out, "language": names, "posterior": pa.array(top), "n_trigrams": pa.array(grams), "kept": pa.array(kept)})

    return each_batch(work)


def identify(
    docs: DataFrame,
    model: Model | None = None,
    id: str = "doc_id",
    text: str = "text",
    declared: str | None = "lang",
    host: str | None = "source",
    url: str | None = None,
    weight: float = WEIGHT,
    strength: float = STRENGTH,
    min_posterior: float = MIN_POSTERIOR,
) -> DataFrame:
    """``docs`` with language, posterior, n_trigrams and kept added (in place of columns of these names).

    ``url`` gives the host where there is no host column; the suffix is the last label of the host.
    """
    model = model or Model.fit(docs, id, text, declared)
    held = Carried(docs, text=text, declared=declared, host=host if url is None else url)
    own = [c for c in held.df.columns if c.startswith("_c")]
    name = F.col("host").cast("string") if url is None else host_of(F.col("host").cast("string"))
    rows = held.df.withColumns({"host": F.coalesce(name, F.lit("")), "text": F.col("text").cast("string"), "declared": F.col("declared").cast("string")})
    rows = rows.withColumn("suffix", suffix_of(F.col("host")))
    added = ["language", "posterior", "n_trigrams", "kept"]
    if not model.languages:
        empty = rows.select(*own, F.lit(None).cast("string").alias("language"), F.lit(0.0).alias("posterior"), F.lit(0).cast("bigint").alias("n_trigrams"), F.lit(False).alias("kept"))
        return held.back(empty, added=added)
    count = len(model.languages)
    small = rows.select("host", "suffix", "declared", "text").mapInArrow(_text_only(model, weight), "host string, suffix string, declared string, best int")
    cells = small.where("best >= 0").groupBy("host", "suffix", "declared", "best").agg(F.count("*").alias("n"))
    by_host, by_declared, overall = _evidence(cells, count, strength)
    rows = join_small(join_small(rows, by_host, "host"), by_declared, "declared")
    work = _fused(model, weight, overall, min_posterior)
    schema = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in own)
    out = rows.select(*own, "text", "prior", "said").mapInArrow(work, f"{schema}, language string, posterior double, n_trigrams bigint, kept boolean")
    return held.back(out, added=added)


def identify_pages(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html", trees=None, model: Model | None = None) -> DataFrame:
    """(id, url, declared, language, posterior, n_trigrams, kept) of every page, by its main text, html lang and address.

    Null, empty and broken pages have no text and are rejected; pages that repeat are rows of their own.  An empty table
    gives an empty result.
    """
    from blockloom.llm.html_extract import extract

    rows = pick(pages, id=id, url=url, html=html).withColumn("html", F.col("html").cast("string"))
    # the declaration travels with the id, so that the page is read and taken apart once
    keyed = rows.select(F.struct("id", markup_language(F.col("html")).alias("declared")).alias("key"), "url", "html")
    texts = stored(extract(keyed, trees, id="key").select("key.id", "url", "key.declared", "text"))
    told = identify(texts, model, id="id", declared="declared", host=None, url="url")
    return told.select(F.col("id").alias(id), F.col("url"), "declared", "language", "posterior", "n_trigrams", "kept")


def _evidence(cells: DataFrame, count: int, strength: float) -> tuple[DataFrame, DataFrame, np.ndarray]:
    """Smoothed priors (host, prior), log p(declared | language) of every declaration (declared, said), and the overall prior."""
    cells = stored(cells)
    total = np.ones(count)
    for r in cells.groupBy("best").agg(F.sum("n").alias("n")).collect():  # one row a language
        total[r["best"]] += r["n"]
    overall = total / total.sum()
    add = lambda c: F.aggregate(c, F.lit(0).cast("bigint"), lambda a, b: a + b)
    dense = F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda j: F.coalesce(F.try_element_at("m", j), F.lit(0).cast("bigint")))
    pairs = F.map_from_entries(F.collect_list(F.struct("best", "n"))).alias("m")
    by = lambda *keys: cells.groupBy(*keys, "best").agg(F.sum("n").alias("n")).groupBy(*keys).agg(pairs).select(*keys, dense.alias("c"))
    up = F.array(*[F.lit(float(x)) for x in overall])
    smooth = lambda c, prior: F.zip_with(c, prior, lambda x, p: (x + strength * p) / (add(c) + strength))
    suffix = by("suffix").select("suffix", smooth(F.col("c"), up).alias("above"))
    hosts = by("host", "suffix").join(suffix, "suffix").select("host", smooth(F.col("c"), F.col("above")).alias("prior"))
    made = cells.where("declared <> ''").select("declared").distinct().count()
    said = by("declared").where("declared <> ''")
    totals = F.array(*[F.lit(float(x) + max(made, 1)) for x in total])
    outside = F.log((add(F.col("c")) + 1) / F.lit(float(total.sum()) + max(made, 1)))
    declared = said.select("declared", F.concat(F.zip_with("c", totals, lambda x, t: F.log((x + 1) / t)), F.array(outside)).alias("said"))
    return hosts, declared, overall
