"""CRC-32 of runs of words, many at a time.

The checksum without its start and end constants is linear: that of two parts is the first one's,
moved on by the length of the second, xor the second one's.  So each word is read once, byte by
byte over all words together, and runs of words are put together from their words.
"""

from __future__ import annotations

import zlib

import numpy as np

_POLY = 0xEDB88320
_ONES = np.uint32(0xFFFFFFFF)
#: Longer words are read one by one.
LONG = 48


def _byte_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> np.uint32(1)) ^ np.uint32(_POLY), t >> np.uint32(1)).astype(np.uint32)
    return t


TABLE = _byte_table()


def _step(c: np.ndarray) -> np.ndarray:
    """Move on by one zero byte."""
    return TABLE[c & np.uint32(0xFF)] ^ (c >> np.uint32(8))


def _operators(powers: int) -> list[np.ndarray]:
    """For each power of two of bytes, what moving on does to each value of each of 4 bytes."""
    base = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])
    ops = [_step(base)]
    for _ in range(powers - 1):
        ops.append(_apply(ops[-1], ops[-1]))
    return ops


def _apply(op: np.ndarray, c: np.ndarray) -> np.ndarray:
    low = np.uint32(0xFF)
    return op[0][c & low] ^ op[1][(c >> np.uint32(8)) & low] ^ op[2][(c >> np.uint32(16)) & low] ^ op[3][c >> np.uint32(24)]


_OPERATORS = _operators(48)


def move(c: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Checksums moved on by n bytes each."""
    c = c.copy()
    most = int(n.max()) if len(n) else 0
    for k in range(most.bit_length()):
        at = np.flatnonzero((n >> k) & 1)
        c[at] = _apply(_OPERATORS[k], c[at])
    return c


_STARTS = np.full(4096, _ONES, np.uint32)
for _i in range(1, len(_STARTS)):
    _STARTS[_i:_i + 1] = _step(_STARTS[_i - 1:_i])


def starts(n: np.ndarray) -> np.ndarray:
    """The start constant moved on by n bytes."""
    if not len(n) or int(n.max()) < len(_STARTS):
        return _STARTS[n]
    return np.where(n < len(_STARTS), _STARTS[np.minimum(n, len(_STARTS) - 1)], move(np.full(len(n), _ONES, np.uint32), n))


def raw_words(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The linear part of the checksum of data[begin:end] for each word."""
    n = end - begin
    out = np.zeros(len(n), np.uint32)
    order = np.argsort(-np.minimum(n, LONG + 1), kind="stable")
    order = order[np.searchsorted(-np.minimum(n, LONG + 1)[order], -LONG):]  # words of LONG bytes at most, long ones first
    length, at, c = n[order], begin[order], np.zeros(len(order), np.uint32)
    ends = np.searchsorted(-length, -np.arange(1, LONG + 1), "right")  # words with so many bytes at least
    for k, m in enumerate(ends.tolist()):
        if not m:
            break
        c[:m] = TABLE[(c[:m] ^ data[at[:m] + k]) & np.uint32(0xFF)] ^ (c[:m] >> np.uint32(8))
    out[order] = c
    far = np.flatnonzero(n > LONG)
    if len(far):
        whole = np.array([zlib.crc32(data[a:b].tobytes()) for a, b in zip(begin[far].tolist(), end[far].tolist())], np.uint32)
        out[far] = ~whole ^ starts(n[far])
    return out


def joined(left: np.ndarray, right: np.ndarray, right_bytes: np.ndarray) -> np.ndarray:
    """Linear parts of ``left + " " + right``."""
    space = TABLE[32]
    return move(move(left, np.ones(len(left), np.int64)) ^ space, right_bytes) ^ right


def finished(raw: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Checksums of texts of n bytes from their linear parts."""
    return ~(raw ^ starts(n))
