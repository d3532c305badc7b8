"""Exact token counts of every prefix of a text, by dynamic programming over the prefixes of its pre-tokens.

The library's byte-level BPE splits a text into pre-tokens and merges inside each.  For a pre-token ``w`` the last token of
each prefix follows from shorter prefixes: it is the one token ``t`` that ends there and whose neighbour, the last token of
the prefix before it, the merges leave beside it (``encode(neighbour + t) == [neighbour, t]``); the count is one more than
that prefix's.  The counts of a text's prefixes are those inside a pre-token on top of the pre-tokens before.  Only ends in
white space need care: a run of it at the end of a prefix is one pre-token, while inside a text its last character goes to
the word that follows.

The operator keeps the step of the count at every character (int16), so any number of truncation and budget questions are
answered by running sums (:func:`counts_at`, :func:`chars_within`) without encoding again.  Special strings in a text count
as one token, as in the library's default.  Null texts count as empty.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from operator import sub

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockloom.llm.tables import each_batch, pick

#: Entries kept in a worker: pre-tokens, pairs of tokens, prefixes; bytes of a pre-token whose prefixes are kept.
MAX_WORDS, MAX_PAIRS, MAX_STATES = 600_000, 400_000, 400_000
MAX_SHARED = 64

# Letters, numbers and white space below U+0250; texts with characters outside this range, or with controls on which
# engines differ, are split by the library itself.
_LETTER, _NUMBER = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ", r"0-9\xb2\xb3\xb9\xbc-\xbe"
_SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^\s{_LETTER}{_NUMBER}]+|\s+(?!\S)|\s+")
_PLAIN = re.compile("[\t\n\r\x20-\x7e\xa1-ɏ‐-‧]*").fullmatch
_RUN = re.compile(r"\s{2,}|\s\Z")
_CONTRACTIONS = {"'re", "'ve", "'ll"}


def _byte_letters() -> dict[str, int]:
    """The printable stand-ins of bytes in vocabulary files of this kind."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Words(dict):
    """Steps of pre-tokens, made when first asked for."""

    def __init__(self, make):
        self.make = make

    def __missing__(self, word: str) -> bytes:
        if len(self) >= MAX_WORDS:
            self.clear()
        got = self[word] = self.make(word)
        return got


class PrefixCounter:
    def __init__(self, blob: bytes):
        from tokenizers import Tokenizer

        spec = json.loads(blob)
        letters = _byte_letters()
        to_bytes = lambda t: bytes(letters[c] for c in t)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.vocab = {to_bytes(t): i for t, i in spec["model"]["vocab"].items() if t not in self.special}
        merges = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        self.ranks = {(to_bytes(a), to_bytes(b)): i for i, (a, b) in enumerate(merges)}
        self.longest = max(map(len, self.vocab))
        self.library = Tokenizer.from_str(blob.decode())
        self.words = _Words(self.steps)
        self.pairs: dict[tuple[bytes, bytes], bool] = {}
        self.states: dict[bytes, tuple[bytes, int]] = {b"": (b"", 0)}  # of prefixes: last token and count
        self.at_special = re.compile("|".join(map(re.escape, self.special))) if self.special else None

    def merged(self, piece: bytes) -> list[bytes]:
        """The merges applied to a few bytes."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get((parts[i], parts[i + 1]), 1 << 60), i) for i in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def beside(self, a: bytes, b: bytes) -> bool:
        """Whether the merges leave the two tokens as they are; ``a`` is empty at the start."""
        got = self.pairs.get((a, b))
        if got is None:
            if len(self.pairs) >= MAX_PAIRS:
                self.pairs.clear()
            got = self.pairs[a, b] = self.merged(a + b) == ([a, b] if a else [b])
        return got

    def _extend(self, data: bytes, done: int) -> None:
        """States of the prefixes of ``data`` longer than ``done``, whose own state is known."""
        states, vocab, pairs, longest = self.states, self.vocab, self.pairs, self.longest
        for i in range(done + 1, len(data) + 1):
            for j in range(max(0, i - longest), i):
                t = data[j:i]
                if t in vocab:
                    last, count = states[data[:j]]
                    ok = pairs.get((last, t))
                    if self.beside(last, t) if ok is None else ok:
                        states[data[:i]] = (t, count + 1)
                        break

    def prefix_counts(self, word: str) -> list[int]:
        """Tokens of each prefix of one pre-token, from the empty one on."""
        data, states = word.encode(), self.states
        n = done = len(data)
        if n > MAX_SHARED:  # prefixes of a long pre-token are not worth keeping
            return self._long_counts(word, data)
        while data[:done] not in states:
            done -= 1
        if done < n:
            if len(states) >= MAX_STATES:
                states.clear()
                states[b""] = (b"", 0)
                done = 0
            self._extend(data, done)
        if n == len(word):
            return [states[data[:i]][1] for i in range(n + 1)]
        ends = np.cumsum([0, *(len(c.encode()) for c in word)]).tolist()
        return [states[data[:e]][1] for e in ends]

    def _long_counts(self, word: str, data: bytes) -> list[int]:
        n = len(data)
        last, count = [b""] * (n + 1), [0] * (n + 1)
        for i in range(1, n + 1):
            for j in range(max(0, i - self.longest), i):
                t = data[j:i]
                if t in self.vocab and self.beside(last[j], t):
                    last[i], count[i] = t, count[j] + 1
                    break
        return [count[e] for e in np.cumsum([0, *(len(c.encode()) for c in word)]).tolist()]

    def steps(self, word: str) -> bytes:
        """The change of the count at each character of a pre-token, as int16."""
        counts = self.prefix_counts(word)
        if word in _CONTRACTIONS:  # cut in the middle, it is a mark and a letter
            counts[2] = counts[1] + self.prefix_counts(word[1])[1]
        return array("h", map(sub, counts[1:], counts)).tobytes()

    def count(self, word: str) -> int:
        return self.prefix_counts(word)[-1]

    def split(self, text: str) -> list[str]:
        if _PLAIN(text):
            return _SPLIT.findall(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def _ordinary(self, text: str) -> np.ndarray:
        """Steps of a text without special strings."""
        words = self.split(text)
        out = np.frombuffer(b"".join(map(self.words.__getitem__, words)), np.int16)
        if "  " in text or not _PLAIN(text) or _RUN.search(text):
            out = self._mended(text, words, out.copy())
        return out

    def _mended(self, text: str, words: list[str], out: np.ndarray) -> np.ndarray:
        """At the last character of a run of white space that precedes a word, the run is one pre-token of its own."""
        at = 0
        for before, word in zip([""] + words, words):
            if before and before.isspace() and word[:1].isspace() and not (len(word) > 1 and word.isspace()):
                run = before + word[0]
                lift = self.count(run) - self.count(before) - self.count(word[0])
                if lift and at + 1 <= len(out):
                    out[at] += lift
                    if at + 1 < len(out):
                        out[at + 1] -= lift
            at += len(word)
        return out

    def text_steps(self, text: str) -> np.ndarray:
        """The change of the count at each character of a text; its sum is the count of the whole."""
        if self.at_special is None or not any(s in text for s in self.special):
            return self._ordinary(text)
        out, at = [], 0
        for m in self.at_special.finditer(text):
            before = text[at : m.start()]
            part = self._ordinary(before + m.group()[:-1])  # unfinished, the string is ordinary text
            whole = int(self._ordinary(before).sum()) + 1
            out += [part, np.array([whole - int(part.sum())], np.int16)]
            at = m.end()
        return np.concatenate([*out, self._ordinary(text[at:])])


_counters: dict[bytes, PrefixCounter] = {}


def counter(blob: bytes) -> PrefixCounter:
    """The counter of a vocabulary file, kept in the worker."""
    key = hashlib.blake2b(blob, digest_size=16).digest()
    if key not in _counters:
        _counters[key] = PrefixCounter(blob)
    return _counters[key]


def token_counts(docs: DataFrame, vocabulary: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, steps) of every row; ``steps`` holds int16 changes of the count by character.

    ``vocabulary`` is the path of a byte-level BPE file; the driver reads it and hands its few megabytes to the tasks.
    """
    with open(vocabulary, "rb") as f:
        blob = f.read()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = counter(blob)
        texts = [t or "" for t in batch["text"].to_pylist()]
        steps = [own.text_steps(t) for t in texts]
        return pa.RecordBatch.from_pydict(
            {
                "id": batch["id"],
                "n_bytes": pa.array([len(t.encode()) for t in texts], pa.int64()),
                "n_tokens": pa.array([int(s.sum()) for s in steps], pa.int64()),
                "steps": pa.array([s.tobytes() for s in steps], pa.binary()),
            }
        )

    rows = pick(docs, id=id, text=text).select("id", F.col("text").cast("string"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, n_bytes bigint, n_tokens bigint, steps binary"
    return rows.mapInArrow(each_batch(work), schema).withColumnRenamed("id", id)


def prefix_table(steps: bytes) -> np.ndarray:
    """Tokens of each prefix, from the empty one to the whole text."""
    return np.concatenate([[0], np.cumsum(np.frombuffer(steps, np.int16), dtype=np.int64)])


def _column(name: str, work) -> Iterator:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = {c: batch[c] for c in batch.schema.names}
            yield pa.RecordBatch.from_pydict({**own, name: pa.array([work(prefix_table(s)) for s in batch["steps"].to_pylist()], pa.int64())})

    return run


def counts_at(counted: DataFrame, chars: int) -> DataFrame:
    """``tokens_at``: tokens of each text cut to ``chars`` characters."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in counted.schema) + ", tokens_at bigint"
    return counted.mapInArrow(_column("tokens_at", lambda t: int(t[min(max(chars, 0), len(t) - 1)])), schema)


def chars_within(counted: DataFrame, budget: int) -> DataFrame:
    """``chars_within``: the longest prefix of each text, in characters, that takes at most ``budget`` tokens."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in counted.schema) + ", chars_within bigint"
    return counted.mapInArrow(_column("chars_within", lambda t: int(np.flatnonzero(t <= max(budget, 0))[-1])), schema)
