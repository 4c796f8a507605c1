"""Word hashes of a batch of texts, vectorised over the bytes of the batch.

A word is a maximal run of bytes other than space and tab to carriage return. Its 64-bit hash is a
polynomial over the bytes, taken from one prefix sum for the whole batch, and then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
BASE = 0x9E3779B97F4A7C55  # odd, so it has an inverse modulo 2**64
INVERSE = pow(BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_PLAIN = np.arange(1, 257, dtype=np.uint64)
_LOWER = _PLAIN.copy()
_LOWER[65:91] = _PLAIN[97:123]


_POWERS: dict[int, np.ndarray] = {}


class Words(NamedTuple):
    hashes: np.ndarray  # uint64, one per word
    begin: np.ndarray  # byte positions in the chunk
    end: np.ndarray
    first: np.ndarray  # per text: index of its first word; one entry more than texts
    data: np.ndarray  # uint8, the chunk


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of a 64-bit hash: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """Powers of ``base`` from 0 to at least ``n`` - 1; those for a chunk are kept."""
    have = _POWERS.get(base)
    if have is not None and len(have) >= n:
        return have
    out = np.full(1 << max(n - 1, 1).bit_length(), base, np.uint64)
    out[0] = 1
    np.multiply.accumulate(out, out=out)
    if len(out) <= 2 * CHUNK:
        _POWERS[base] = out
    return out


def _width(kind: pa.DataType) -> type:
    return np.int64 if pa.types.is_large_string(kind) or pa.types.is_large_binary(kind) else np.int32


def texts(batch: pa.RecordBatch, place: int | None) -> pa.Array:
    """The texts of a batch as ``common.rows_and_text`` lays it out, null as empty."""
    return (batch.column(1) if place is None else batch.column(0).field(place)).fill_null("")


def chunks(column: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``size`` bytes, or of one text where that is longer."""
    if len(column) == 0:
        return
    offsets = np.frombuffer(column.buffers()[1], _width(column.type))
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    at = 0
    while at < len(column):
        to = int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1
        to = min(max(to, at + 1), len(column))
        yield at, to
        at = to


def words(column: pa.Array, at: int, to: int, lower: bool = False) -> Words:
    """Words of the texts ``at`` to ``to`` of a string or binary column without nulls."""
    part = column.slice(at, to - at)
    offsets = np.frombuffer(part.buffers()[1], _width(part.type))
    offsets = offsets[part.offset : part.offset + len(part) + 1].astype(np.int64)
    low, high = int(offsets[0]), int(offsets[-1])
    data = np.frombuffer(part.buffers()[2], np.uint8, high - low, low) if high > low else np.zeros(0, np.uint8)
    offsets = offsets - low
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), none, none, np.zeros(len(part) + 1, np.int64), data)
    inside = ~_SPACE[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    edges = offsets[1:-1]
    edges = edges[edges < n]
    starts[edges] |= inside[edges]  # a text may begin right after the last byte of another
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | starts[1:]
    begin, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    values = (_LOWER if lower else _PLAIN)[data]
    values *= powers(BASE, n)[:n]
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    hashes = mix((total[end] - total[begin]) * powers(INVERSE, n)[begin] + (end - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return Words(hashes, begin, end, np.searchsorted(begin, offsets), data)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words from each position on; the caller leaves out those beyond a text."""
    n = max(len(hashes) - k + 1, 0)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total += hashes[j : j + n] * np.uint64(pow(0xC2B2AE3D27D4EB4F, j + 1, 1 << 64))
    return mix(total + np.uint64(k))


def shingle_sets(w: Words, k: int) -> Iterator[np.ndarray]:
    """Per text its distinct k-word shingles, ascending; fewer words make one shingle, none none."""
    g = grams(w.hashes, k)
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        if b - a >= k:
            yield np.unique(g[a : b - k + 1])
        elif b > a:
            yield grams(w.hashes[a:b], b - a)
        else:
            yield g[:0]
