"""Words of whole texts as arrays: one pass over the UTF-8 bytes of an Arrow column.

A word is a run of bytes other than space and 0x09-0x0D; A-Z count as a-z.  Both rules look
at ASCII bytes only, so they hold on UTF-8 as they do on code points.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: For terms of letters and digits: all ASCII bytes but those separate.
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE = _BYTE[LOWER]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: ASCII punctuation, for words without it at their ends.
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_powers: dict[str, np.ndarray] = {}

PIECE_BYTES = 1 << 20


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * _MIX1
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) <= n:
        size = max(n, PIECE_BYTES)
        for key, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[key] = np.multiply.accumulate(p)
    return _powers["up"], _powers["down"]


@dataclass
class Words:
    """Words of some texts: byte range and 64-bit hash of each, and where each text begins."""

    data: np.ndarray  # bytes of all texts
    offsets: np.ndarray  # first byte of each text, and the end
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # first word of each text, and the number of words
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def split(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SEPARATOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last+1 byte of every word, and the first word of each text."""
    n = len(data)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~separator[data]
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < n)]
    begin[edges] = inside[edges]
    end[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def trim(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words without ASCII punctuation at either end; words of nothing else are left out."""
    solid = np.flatnonzero(~_PUNCTUATION[data])
    left, right = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
    keep = left < right
    starts, ends = solid[left[keep]], solid[right[keep] - 1] + 1
    return starts, ends, np.searchsorted(starts, offsets)


def words(data: np.ndarray, offsets: np.ndarray, trimmed: bool = False, separator: np.ndarray = SEPARATOR) -> Words:
    starts, ends, first = split(data, offsets, separator)
    if trimmed and len(starts):
        starts, ends, first = trim(data, offsets, starts, ends)
    n = len(data)
    up, down = _power_tables(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:n], out=total[1:])
    h = (total[ends] - total[starts]) * down[starts]
    return Words(data, offsets, starts, ends, first, mix(h + (ends - starts).astype(np.uint64)))


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; nulls are empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("") if column.null_count else column
    wide = pa.types.is_large_string(column.type)
    offs = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    offs = offs.astype(np.int64) if len(offs) else np.zeros(1, np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offs[0]:offs[-1]] if raw is not None and offs[-1] else np.empty(0, np.uint8)
    return data, offs - offs[0]


def pieces(batch: pa.RecordBatch, column: str = "text", limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of a batch with about ``limit`` bytes of text (one text at least), each with
    its bytes and offsets: bounds the memory of what is computed from them."""
    n = batch.num_rows
    if not n:
        return
    data, offs = text_bytes(batch.column(column))
    a = 0
    while a < n:
        b = int(np.searchsorted(offs, offs[a] + limit, "right")) - 1
        b = min(n, max(b, a + 1))
        yield a, b, data[offs[a]:offs[b]], offs[a:b + 1] - offs[a]
        a = b


def word_hashes(data: np.ndarray, offsets: np.ndarray, limit: int = PIECE_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and the number of words of each text, about ``limit`` bytes at a time."""
    hashes, counts, a, n = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], 0, len(offsets) - 1
    while a < n:
        b = min(n, max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1))
        w = words(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
        hashes.append(w.hashes)
        counts.append(w.counts)
        a = b
    return np.concatenate(hashes), np.concatenate(counts)


def shingles(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of every text, and the first shingle of each text (and
    their number).  A text of fewer words has one, its whole sequence; one without words none."""
    n = w.counts
    have = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    first = np.concatenate([[0], np.cumsum(have)])
    at = np.arange(first[-1]) - np.repeat(first[:-1], have) + np.repeat(w.first[:-1], have)
    left = np.minimum(k, np.repeat(n, have))
    padded = np.concatenate([w.hashes, np.zeros(k, np.uint64)])
    h = left.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for j in range(k):
        h = mix(h) + np.where(j < left, padded[at + j], np.uint64(0)) * np.uint64(2 * j + 1)
    return mix(h), first


def distinct(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each group, sorted within it."""
    g = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((values, g))
    v, g = values[order], g[order]
    keep = np.ones(len(v), bool)
    keep[1:] = (v[1:] != v[:-1]) | (g[1:] != g[:-1])
    v, g = v[keep], g[keep]
    return v, np.searchsorted(g, np.arange(len(first)))
