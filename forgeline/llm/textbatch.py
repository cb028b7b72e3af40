"""Vectorised word, hash and n-gram helpers over one Arrow batch of texts.

A word is a maximal run of bytes other than space and the ASCII controls 9-13 of one text.  Everything
here works on the UTF-8 bytes of a batch at once, so a task's memory is a small multiple of its batch.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_WS = np.zeros(256, dtype=bool)
_WS[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_CHUNK = 1 << 20  # bytes hashed at a time


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = x + _GOLD
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def coefficients(n: int, seed: int) -> np.ndarray:
    """n odd pseudo-random 64-bit factors."""
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * _GOLD + np.uint64(seed)) | np.uint64(1)


@dataclass
class Batch:
    """Words of the texts of one batch, in order."""

    data: np.ndarray      # UTF-8 bytes of all texts
    offsets: np.ndarray   # byte offsets of the texts, one more than texts
    starts: np.ndarray    # byte offset of each word
    ends: np.ndarray
    doc: np.ndarray       # text index of each word
    first: np.ndarray     # word offsets of the texts, one more than texts

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.first)

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()

    def per_doc(self, mask: np.ndarray) -> np.ndarray:
        """Number of set bytes of each text."""
        total = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
        return total[self.offsets[1:]] - total[self.offsets[:-1]]


def utf8(col) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
        if isinstance(col, pa.ChunkedArray):
            col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], col.type)
    if col.type != pa.large_string():
        col = col.cast(pa.large_string())
    if col.null_count:
        col = col.fill_null("")
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64)[col.offset:col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def parse(col, lower: bool = False, gap: np.ndarray = _WS) -> Batch:
    """Split every text of a column into words, maximal runs of bytes that are no gap; lower: A-Z become a-z first."""
    data, offsets = utf8(col)
    if lower:
        data = _LOWER[data]
    word = ~gap[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.concatenate(([True], ~word[:-1])) if len(word) else word
    after = np.concatenate((~word[1:], [True])) if len(word) else word
    starts = np.flatnonzero(word & (before | edge[:-1]))
    ends = np.flatnonzero(word & (after | edge[1:])) + 1
    first = np.searchsorted(starts, offsets, side="left")
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Batch(data, offsets, starts, ends, doc, first)


def word_hashes(b: Batch, seed: int = 7) -> np.ndarray:
    """A 64-bit hash of each word."""
    n = len(b.starts)
    out = np.zeros(n, np.uint64)
    if not n:
        return out
    factors = coefficients(int((b.ends - b.starts).max()), seed)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(b.starts, b.starts[lo] + _CHUNK)))
        s, e = b.starts[lo:hi], b.ends[lo:hi]
        size = e - s
        at = np.concatenate(([0], np.cumsum(size)))
        within = np.arange(at[-1]) - np.repeat(at[:-1], size)
        value = b.data[within + np.repeat(s, size)].astype(np.uint64) + np.uint64(1)
        out[lo:hi] = np.add.reduceat(value * factors[within], at[:-1]) + size.astype(np.uint64)
        lo = hi
    return mix64(out)


def ngrams(hashes: np.ndarray, n: int, seed: int = 11) -> np.ndarray:
    """Hash of the n words from each position on; the last n - 1 positions are left out."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(m, np.uint64)
    for j, f in enumerate(coefficients(n, seed)):
        total += hashes[j:j + m] * f
    return mix64(total)


def inside(b: Batch, n: int) -> np.ndarray:
    """For each position that n-grams of the batch start at: does it lie within one text?"""
    m = len(b.doc) - n + 1
    return b.doc[:m] == b.doc[n - 1:] if m > 0 else np.zeros(0, bool)


def strings(b: Batch, keep: np.ndarray) -> list[bytes]:
    """Each text's kept words, joined by one space."""
    from itertools import compress

    out, flags = [], keep.tolist()
    for i in range(len(b)):
        lo, hi = b.first[i], b.first[i + 1]
        words = b.text(i).split()
        if not keep[lo:hi].all():
            words = compress(words, flags[lo:hi])
        out.append(b" ".join(words))
    return out
