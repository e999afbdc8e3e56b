"""Vectorised word and shingle hashes over whole Arrow batches of texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_U = np.uint64
_BLOCK = 1 << 21

# Words end at blank and \t \n \v \f \r; A-Z is lower-cased.
FOLD_SPACE = np.array([0x20 if b == 0x20 or 0x09 <= b <= 0x0D else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)
# Words end at every ASCII character but letters and digits.
FOLD_ALNUM = np.array([b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
                       for b in range(256)], np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _U(0x9E3779B97F4A7C15) | _U(1))
    out[0] = 1
    return np.multiply.accumulate(out)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its n + 1 offsets; NULL has no bytes."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]] if len(column) else np.zeros(0, np.uint8)
    return data, offsets - offsets[0] if len(column) else np.zeros(1, np.int64)


def word_hashes(column: pa.Array, fold: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of each word of all texts in a row, n + 1 offsets of the texts' words)."""
    data, offsets = text_bytes(column)
    data = fold[data]
    n = len(data)
    if not n:
        return np.zeros(0, _U), np.zeros(len(offsets), np.int64)
    inside = data != 0x20
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = offsets[1:-1]
    cuts = cuts[cuts < n]
    first[cuts] |= inside[cuts]
    starts = np.flatnonzero(first)
    out = np.zeros(len(starts), _U)
    k = 0
    while k < len(starts):  # in blocks that end with a word, so that scratch space is bounded
        to = max(k + 1, int(np.searchsorted(starts, starts[k] + _BLOCK)))
        a, b = starts[k], starts[to] if to < len(starts) else n
        own = starts[k:to] - a
        lengths = np.diff(np.append(own, b - a))
        place = np.arange(b - a) - np.repeat(own, lengths)
        values = (data[a:b].astype(_U) * inside[a:b] + inside[a:b]) * _powers(int(lengths.max()))[place]
        out[k:to] = np.add.reduceat(values, own)
        k = to
    return mix(out), np.searchsorted(starts, offsets).astype(np.int64)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words (all of them, in place order)."""
    if len(words) < size:
        return np.zeros(0, _U)
    out = np.zeros(len(words) - size + 1, _U)
    factors = mix(np.arange(1, size + 1, dtype=_U) * _U(0xD6E8FEB86659FD93)) | _U(1)
    for j in range(size):
        out += words[j:len(words) - size + 1 + j] * factors[j]
    return mix(out)
