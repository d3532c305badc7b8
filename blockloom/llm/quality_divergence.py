"""Quality rules by distribution divergence: how far a document's characters and common words are from its language's.

One pass sums, for each language of the label column, a histogram of character classes and counts of words in
``WORD_CELLS`` cells of a hash.  The *common words* of a language are the cells with at least ``COMMON_SHARE`` of its words
(so at most 1 / COMMON_SHARE); the rest is one cell.  A document is compared with its language by the Jensen-Shannon
distance (root of the divergence in bits, 0 to 1) of both histograms.  Small samples diverge by chance by about
(cells - 1) / (8 ln 2 length), which is taken off first, and below the minimum lengths a distance is not judged at all.

Every language with ``REFERENCE_WORDS`` words or more has a reference of its own, whatever its share: the ``HELD`` largest
go to the tasks at once, those of further languages are a table of common cells that is joined to the documents by
language.  A language of fewer words is too short to be a reference: as with short documents, its distances are not judged
and are null.  A null label uses the pooled reference, under the same minimum.  Base rules fail a document with fewer than
50 words or with more than half of its words in repeated 3-word windows.  A null text has no words and fails; repeated rows are judged alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockloom.llm.tables import each_batch, join_small, pick, stored
from blockloom.llm.words import mix, pieces, raw, slices, span_hashes, spans, SLICE_BYTES

WORD_CELLS = 1 << 12
COMMON_SHARE = 0.002
REFERENCE_WORDS = 1000
HELD = 1000
#: Languages beyond the held ones whose references (8 KB each at most) are broadcast; more are joined by salted keys.
BROADCAST_REFERENCES = 4000
POOLED = "*"
#: Production thresholds and length guards.
MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE = 0.28, 0.285
MIN_CHARS, MIN_WORDS = 200, 50

# Character classes: lower, upper, digit, white space, sentence marks, symbols, other ASCII, beyond ASCII.
CLASSES = 8
_CLASS = np.full(256, 6, np.int64)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 0, 1, 2
_CLASS[[0x20, *range(0x09, 0x0E)]] = 3
_CLASS[[ord(c) for c in ".,;:!?'\"()-"]] = 4
_CLASS[[ord(c) for c in "#*$%&|<>"]] = 5
_CLASS[0xC0:] = 7
_SKIP = 8  # later bytes of a character
_CLASS[0x80:0xC0] = _SKIP


def _repeated(words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each text, its words in 3-word windows that occur twice or more in it."""
    n = len(ends) - 1
    owner = np.repeat(np.arange(n), np.diff(ends))
    covered = np.zeros(len(words), bool)
    if len(words) >= 3:
        windows = mix(mix(mix(words[:-2]) + words[1:-1]) + words[2:])
        whole = np.flatnonzero(owner[2:] == owner[:-2])
        keys = mix(windows[whole] + owner[whole].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(keys)
        same = keys[order][1:] == keys[order][:-1]
        twice = np.zeros(len(keys), bool)
        twice[order[1:]] |= same
        twice[order[:-1]] |= same
        for k in range(3):
            covered[whole[twice] + k] = True
    return np.bincount(owner, weights=covered, minlength=n).astype(np.int64)


def _lines(data: np.ndarray, offsets: np.ndarray, word_starts: np.ndarray) -> np.ndarray:
    """For each text, its lines with a word that equal an earlier one."""
    n = len(offsets) - 1
    breaks = np.flatnonzero(data == 0x0A)
    starts = np.unique(np.concatenate([offsets[:-1][np.diff(offsets) > 0], breaks + 1]))
    starts = starts[starts < len(data)]
    ends = np.minimum(np.concatenate([starts[1:], [len(data)]]), len(data))
    if not len(starts):
        return np.zeros(n, np.int64)
    closed = data[ends - 1] == 0x0A
    has_word = np.searchsorted(word_starts, ends) > np.searchsorted(word_starts, starts)
    owner = np.searchsorted(offsets, starts, "right") - 1
    starts, ends, owner = starts[has_word], (ends - closed)[has_word], owner[has_word]
    keys = mix(span_hashes(data, starts, ends) + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first = np.unique(keys, return_index=True)
    again = np.ones(len(keys), bool)
    again[first] = False
    return np.bincount(owner, weights=again, minlength=n).astype(np.int64)


def _long_lines(data: np.ndarray) -> int:
    """The same for one long text, line by line."""
    seen, again = set(), 0
    for line in data.tobytes().split(b"\n"):
        if line.translate(None, b" \t\n\x0b\x0c\r"):
            again += line in seen
            seen.add(line)
    return again


def measure(column: pa.Array) -> Iterator[tuple[int, dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]]:
    """By slices of texts: first text, base counts, character classes (texts x CLASSES), word hashes and their offsets."""
    data, offsets = raw(column)
    for at, to in slices(offsets):
        part = data[offsets[at] : offsets[to]]
        own = offsets[at : to + 1] - offsets[at]
        n = to - at
        if n == 1 and len(part) > 2 * SLICE_BYTES:
            words, classes, again = [], np.zeros((1, CLASSES + 1), np.int64), _long_lines(part)
            for piece in pieces(part):
                words.append(spans(piece, np.array([0, len(piece)])).hashes())
                classes[0] += np.bincount(_CLASS[piece], minlength=CLASSES + 1)
            words = np.concatenate(words)
            ends, dup = np.array([0, len(words)]), np.array([again])
        else:
            s = spans(part, own)
            words, ends = s.hashes(), np.searchsorted(s.starts, own)
            owner = np.repeat(np.arange(n), np.diff(own))
            classes = np.bincount(owner * (CLASSES + 1) + _CLASS[part], minlength=n * (CLASSES + 1)).reshape(n, -1)
            dup = _lines(part, own, s.starts)
        classes = classes[:, :CLASSES]
        base = {
            "n_words": np.diff(ends),
            "word_chars": classes.sum(axis=1) - classes[:, 3],
            "n_symbols": classes[:, 5],
            "n_dup_lines": dup,
            "n_repeat_words": _repeated(words, ends),
        }
        yield at, base, classes, words, ends


def _word_cells(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.repeat(np.arange(len(ends) - 1), np.diff(ends)), (words >> np.uint64(52)).astype(np.int64)


def _histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, words, counts): sums over a task's documents, character classes first, then word cells."""
    held: dict[str, np.ndarray] = {}

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {"lang": pa.array(list(held), pa.string()), "words": pa.array([int(v[CLASSES:].sum()) for v in held.values()], pa.int64()), "counts": pa.array([v.tobytes() for v in held.values()], pa.binary())}
        )

    for batch in batches:
        langs = batch["lang"].to_pylist()
        for at, _, classes, words, ends in measure(batch["text"]):
            names = langs[at : at + len(classes)]
            owner, cells = _word_cells(words, ends)
            of = {name: i for i, name in enumerate(dict.fromkeys(names))}
            row = np.array([of[x] for x in names])
            count = np.bincount(row[owner] * WORD_CELLS + cells, minlength=len(of) * WORD_CELLS).reshape(-1, WORD_CELLS)
            for name, i in of.items():
                got = np.concatenate([classes[row == i].sum(axis=0), count[i]])
                for key in (POOLED, name) if name is not None else (POOLED,):
                    held[key] = held[key] + got if key in held else got
            if len(held) > 256:
                yield out()
                held.clear()
    if held:
        yield out()


def _sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, np.ndarray] = {}
    for batch in batches:
        for k, blob in zip(batch["lang"].to_pylist(), batch["counts"].to_pylist()):
            got = np.frombuffer(blob, np.int64)
            held[k] = held[k] + got if k in held else got
    if held:
        yield pa.RecordBatch.from_pydict(
            {"lang": pa.array(list(held), pa.string()), "words": pa.array([int(v[CLASSES:].sum()) for v in held.values()], pa.int64()), "counts": pa.array([v.tobytes() for v in held.values()], pa.binary())}
        )


Reference = tuple[np.ndarray, np.ndarray, np.ndarray]


def _reference(batch: pa.RecordBatch) -> pa.RecordBatch:
    """(lang, words, chars, common, shares): class shares, common word cells, shares of those cells and the rest."""
    out: dict[str, list] = {"chars": [], "common": [], "shares": []}
    for blob in batch["counts"].to_pylist():
        counts = np.frombuffer(blob, np.int64).astype(float)
        chars, cells = counts[:CLASSES], counts[CLASSES:]
        cells = cells / max(cells.sum(), 1)
        common = np.flatnonzero(cells >= COMMON_SHARE)
        out["chars"].append(chars / max(chars.sum(), 1))
        out["common"].append(common.astype(np.int32))
        out["shares"].append(np.append(cells[common], 1 - cells[common].sum()))
    kinds = {"chars": pa.list_(pa.float64()), "common": pa.list_(pa.int32()), "shares": pa.list_(pa.float64())}
    return pa.RecordBatch.from_pydict({"lang": batch["lang"], "words": batch["words"], **{c: pa.array(v, kinds[c]) for c, v in out.items()}})


def references(docs: DataFrame, text: str = "text", lang: str = "lang", held: int = HELD) -> tuple[dict[str, Reference], DataFrame | None]:
    """References of POOLED and the ``held`` largest languages, and a table (lang, reference) of the others, None if there are none.

    A corpus of fewer than ``REFERENCE_WORDS`` words has no reference at all.
    """
    schema = "lang string, words bigint, counts binary"
    docs = pick(docs, text=text, lang=lang).select(F.col("text").cast("string"), F.col("lang").cast("string"))
    sums = docs.mapInArrow(_histograms, schema).repartition("lang").mapInArrow(_sum, schema)
    sums = sums.where(F.col("words") >= REFERENCE_WORDS)
    table = stored(sums.mapInArrow(each_batch(_reference), "lang string, words bigint, chars array<double>, common array<int>, shares array<double>"))
    order = [F.col("lang") != POOLED, F.desc("words"), F.col("lang")]
    top = table.orderBy(*order).limit(held + 1).collect()
    out = {r["lang"]: (np.array(r["chars"]), np.array(r["common"], np.int64), np.array(r["shares"])) for r in top}
    if len(top) <= held:
        return out, None
    last = top[-1]
    rest = table.where((F.col("lang") != POOLED) & ((F.col("words") < last["words"]) | ((F.col("words") == last["words"]) & (F.col("lang") > last["lang"]))))
    return out, rest.select("lang", F.struct("chars", "common", "shares").alias("reference"))


def _plogp(p: np.ndarray) -> np.ndarray:
    return (p * np.log2(np.where(p > 0, p, 1))).sum(axis=1)


def distance(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of counts to the reference, less what its length makes likely by chance."""
    n = np.maximum(counts.sum(axis=1, keepdims=True), 1)
    p = counts / n
    middle = (p + reference) / 2
    bits = (_plogp(p) + _plogp(reference[None, :])) / 2 - _plogp(middle)
    chance = (len(reference) - 1) / (8 * np.log(2) * n[:, 0])
    return np.sqrt(np.clip(bits - chance, 0, 1))


OUTPUT = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, char_distance double, word_distance double, kept boolean"


def _placed(chars: np.ndarray, common: np.ndarray, shares: np.ndarray) -> Reference:
    place = np.full(WORD_CELLS, len(common), np.int64)
    place[common] = np.arange(len(common))
    return chars, place, shares


def _judge(refs: dict[str, Reference], max_char: float, max_word: float, min_chars: int, min_words: int):
    held = {name: _placed(*ref) for name, ref in refs.items()}

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        k = batch.num_rows
        table = dict(held)
        if "reference" in batch.schema.names:
            for i, name in enumerate(batch["lang"].to_pylist()):
                if name is not None and name not in table and batch["reference"][i].is_valid:
                    ref = batch["reference"][i].as_py()
                    table[name] = _placed(np.array(ref["chars"]), np.array(ref["common"], np.int64), np.array(ref["shares"]))
        langs = [POOLED if x is None else x for x in batch["lang"].to_pylist()]
        langs = [x if x in table else None for x in langs]
        got: dict[str, np.ndarray] = {c: np.zeros(k, np.int64) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}
        char_d, word_d, n_chars = np.zeros(k), np.zeros(k), np.zeros(k, np.int64)
        for at, base, classes, words, ends in measure(batch["text"]):
            m = len(classes)
            for c, v in base.items():
                got[c][at : at + m] = v
            n_chars[at : at + m] = classes.sum(axis=1)
            owner, cells = _word_cells(words, ends)
            names = np.array(langs[at : at + m], object)
            for name in set(names) - {None}:
                chars, place, shares = table[name]
                rows = np.flatnonzero(names == name)
                char_d[at + rows] = distance(classes[rows], chars)
                mine = np.full(m, -1)
                mine[rows] = np.arange(len(rows))
                own = mine[owner]
                ok = own >= 0
                counts = np.bincount(own[ok] * len(shares) + place[cells[ok]], minlength=len(rows) * len(shares)).reshape(len(rows), -1)
                word_d[at + rows] = distance(counts, shares)
        failed = (got["n_words"] < 50) | (100 * got["n_repeat_words"] > 50 * got["n_words"])
        far = ((char_d > max_char) & (n_chars >= min_chars)) | ((word_d > max_word) & (got["n_words"] >= min_words))
        unjudged = np.array([x is None for x in langs], bool)
        return pa.RecordBatch.from_pydict({"id": batch["id"], **got, "base_failed": failed, "char_distance": pa.array(char_d, mask=unjudged), "word_distance": pa.array(word_d, mask=unjudged), "kept": ~failed & ~far})

    return each_batch(work)


def quality(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    max_char: float = MAX_CHAR_DISTANCE,
    max_word: float = MAX_WORD_DISTANCE,
    min_chars: int = MIN_CHARS,
    min_words: int = MIN_WORDS,
    held: int = HELD,
) -> DataFrame:
    """Base counts, distances and the verdict for every row of ``docs``."""
    refs, more = references(docs, text, lang, held)
    rows = pick(docs, id=id, text=text, lang=lang).select("id", F.col("text").cast("string"), F.col("lang").cast("string"))
    kind = rows.schema["id"].dataType.simpleString()
    if more is not None:
        rows = join_small(rows, more, "lang", limit=BROADCAST_REFERENCES)
    return rows.mapInArrow(_judge(refs, max_char, max_word, min_chars, min_words), f"id {kind}, {OUTPUT}").withColumnRenamed("id", id)
