"""Words and word hashes of many texts at once, on the UTF-8 bytes of an Arrow column.

A word is a run of bytes outside space and 0x09-0x0D, which is `[^\\x20\\x09-\\x0D]+` on the characters as well, since no
byte of a longer UTF-8 sequence falls into that range.  All arithmetic is on 64-bit integers that wrap.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes worked on at once; a longer text goes through in pieces that end between words.
SLICE_BYTES = 1 << 20

_U = np.uint64
_ROOT = _U(0x9E3779B97F4A7C15)
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits all depend on all input bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


with np.errstate(over="ignore"):
    _CODE = mix(np.arange(1, 257, dtype=_U) * _ROOT)
_LOWER_CODE = _CODE.copy()
_LOWER_CODE[65:91] = _CODE[97:123]
_INVERSE = _U(pow(int(_ROOT), -1, 1 << 64))
_powers: dict[int, np.ndarray] = {}


def _power(base: np.uint64, n: int) -> np.ndarray:
    """base**0 ... base**n, kept between calls."""
    have = _powers.get(int(base))
    if have is None or len(have) <= n:
        size = max(n, SLICE_BYTES) + 1
        have = np.full(size, base, _U)
        have[0] = 1
        have = np.cumprod(have, dtype=_U)
        if size <= 4 * SLICE_BYTES:
            _powers[int(base)] = have
    return have[: n + 1]


@dataclass
class Spans:
    """Bytes of a slice with the places of its words."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    _sums: np.ndarray | None = None

    def hashes(self, lower: bool = False) -> np.ndarray:
        """A 64-bit hash of each word; equal words have equal hashes in all slices."""
        return span_hashes(self.data, self.starts, self.ends, lower)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, from one running polynomial over the slice."""
    n = len(data)
    sums = np.zeros(n + 1, _U)
    np.cumsum((_LOWER_CODE if lower else _CODE)[data] * _power(_ROOT, n)[:n], out=sums[1:])
    value = (sums[ends] - sums[starts]) * _power(_INVERSE, n)[starts]
    return mix(value + (ends - starts).astype(_U) * _U(0xD1B54A32D192ED03))


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the n+1 offsets of its texts; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1] if buffers[1] else np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data, offsets


def spans(data: np.ndarray, offsets: np.ndarray) -> Spans:
    """Words of texts that lie one after the other; no word crosses from one text to the next."""
    inside = ~_SEPARATOR[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    return Spans(data, np.flatnonzero(first), np.flatnonzero(last) + 1)


def slices(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about SLICE_BYTES together; a longer text stands alone."""
    n, at = len(offsets) - 1, 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, "right")) - 1
        to = min(max(to, at + 1), n)
        yield at, to
        at = to


def pieces(data: np.ndarray) -> Iterator[np.ndarray]:
    """A long text in pieces of about SLICE_BYTES that end between words."""
    at = 0
    while at < len(data):
        to = min(at + SLICE_BYTES, len(data))
        while to < len(data):
            gap = np.flatnonzero(_SEPARATOR[data[to : to + SLICE_BYTES]])
            if len(gap):
                to += int(gap[0])
                break
            to = min(to + SLICE_BYTES, len(data))
        yield data[at:to]
        at = to


def word_hashes(column: pa.Array, lower: bool = False) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each slice of texts: number of its first text, hashes of all its words, and n+1 offsets into them."""
    data, offsets = raw(column)
    for at, to in slices(offsets):
        part = data[offsets[at] : offsets[to]]
        if to - at == 1 and len(part) > 2 * SLICE_BYTES:
            found = np.concatenate([spans(x, np.array([0, len(x)])).hashes(lower) for x in pieces(part)] or [np.zeros(0, _U)])
            yield at, found, np.array([0, len(found)])
        else:
            own = offsets[at : to + 1] - offsets[at]
            s = spans(part, own)
            yield at, s.hashes(lower), np.searchsorted(s.starts, own)


_STEPS = mix(np.arange(11, 43, dtype=_U) * _ROOT) | _U(1)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words; of the whole sequence if it is shorter, of nothing if it is empty."""
    n = len(words)
    if n == 0:
        return np.zeros(0, _U)
    k = min(size, n)
    total = np.full(n - k + 1, _U(k), _U)
    for i in range(k):
        total += words[i : n - k + 1 + i] * _STEPS[i % 32]
        total = mix(total)
    return total


def line_groups(data: np.ndarray) -> Iterator[np.ndarray]:
    """A long text in groups of whole lines of about SLICE_BYTES; a longer line stands alone."""
    edges = np.unique(np.concatenate([[0], np.flatnonzero(data == 0x0A) + 1, [len(data)]]))
    at = 0
    while at < len(edges) - 1:
        to = max(int(np.searchsorted(edges, edges[at] + SLICE_BYTES, "right")) - 1, at + 1)
        yield data[edges[at] : edges[to]]
        at = to
