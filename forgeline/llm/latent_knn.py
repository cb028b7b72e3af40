"""Quality classification by nearest-neighbour voting in a latent-semantic space.

A text's features are its words, the shapes of its words (letters, digits, marks) and a few coarse properties
(repetition, marks, length), hashed into DIMS counts.  Latent vectors are the leading right singular vectors of the
TF-IDF matrix of a bounded labelled sample.  The labelled vectors are broadcast (at most 2 * FIT_ROWS of RANK
numbers), every document's cosine to each of them is computed exactly, a block of documents at a time, and the
K nearest vote with their label, weighted by similarity.

Null and empty texts have the features of an empty text and are scored like others.  Null labels and null doc_ids
take no part in the fit.  Without labelled rows the score is 0.5; equal similarities go to the earlier labelled row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgeline.llm.textbatch import Batch, coefficients, mix64, parse, word_hashes

DIMS = 4096
RANK = 64
K = 25
THRESHOLD = 0.3
_WORD_DIMS, _SHAPE_DIMS = 2048, 1536  # the rest: coarse properties


def _shape_classes() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[97:123], t[65:91], t[48:58], t[128:] = 97, 65, 48, 97
    return t


_SHAPE = _shape_classes()


def _shapes(b: Batch) -> np.ndarray:
    """Hash of each word's shape: its bytes' classes, runs as one."""
    c = _SHAPE[b.data]
    inside = np.zeros(len(c), bool)
    change = np.concatenate(([True], c[1:] != c[:-1])) if len(c) else np.zeros(0, bool)
    change[b.starts] = True
    mark = np.zeros(len(c) + 1, np.int64)
    np.add.at(mark, b.starts, 1)
    np.add.at(mark, b.ends, -1)
    inside = np.cumsum(mark[:-1]) > 0
    at = np.flatnonzero(change & inside)
    first = np.searchsorted(at, b.starts)
    if not len(at):
        return np.zeros(len(b.starts), np.uint64)
    within = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
    return mix64(np.add.reduceat((c[at].astype(np.uint64) + np.uint64(1)) * coefficients(int(within.max()) + 1, 23)[within], first))


def counts(b: Batch) -> np.ndarray:
    """Feature counts of each text (texts x DIMS)."""
    n = len(b)
    h = word_hashes(b)
    cells = [b.doc * DIMS + (h % np.uint64(_WORD_DIMS)).astype(np.int64),
             b.doc * DIMS + _WORD_DIMS + (_shapes(b) % np.uint64(_SHAPE_DIMS)).astype(np.int64)]
    x = np.bincount(np.concatenate(cells), minlength=n * DIMS).reshape(n, DIMS).astype(np.float32)
    words = np.maximum(b.n_words, 1)
    pair = np.unique(np.column_stack([b.doc.astype(np.uint64), h]), axis=0)[:, 0].astype(np.int64) if len(h) else np.zeros(0, np.int64)
    same = np.zeros(len(h), bool)
    if len(h) > 1:
        same[1:] = (h[1:] == h[:-1]) & (b.doc[1:] == b.doc[:-1])
    letters = np.zeros(256, bool)
    letters[97:123] = letters[65:91] = letters[128:] = True
    upper = np.zeros(256, bool)
    upper[65:91] = True
    solid = b.per_doc(b.data > 32)
    shares = [np.bincount(pair, minlength=n) / words, np.bincount(b.doc[same], minlength=n) / words,
              b.per_doc(letters[b.data]) / np.maximum(solid, 1), b.per_doc(upper[b.data]) / np.maximum(solid, 1),
              np.minimum(np.log2(words) / 16, 1)]
    room = (DIMS - _WORD_DIMS - _SHAPE_DIMS) // len(shares)
    for j, s in enumerate(shares):
        step = np.minimum((s * 12).astype(np.int64), room - 1)
        x[np.arange(n), _WORD_DIMS + _SHAPE_DIMS + j * room + step] += np.maximum(words / 8, 1)  # as heavy as a common word
    return x


@dataclass
class Model:
    weight: np.ndarray    # of each feature
    axes: np.ndarray      # DIMS x rank
    vectors: np.ndarray   # labelled rows x rank, of length 1
    labels: np.ndarray


def _tfidf(x: np.ndarray, weight: np.ndarray) -> np.ndarray:
    x = np.log1p(x) * weight
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def fit(sample: list[tuple[bytes, int]], rank: int = RANK, seed: int = 5) -> Model:
    """Latent axes by a randomised singular value decomposition of the sample's TF-IDF matrix."""
    if not sample:
        return Model(np.zeros(DIMS, np.float32), np.zeros((DIMS, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0, np.float32))
    x = np.concatenate([counts(parse(pa.array([t.decode() for t, _ in sample[i:i + 200]]))) for i in range(0, len(sample), 200)])
    weight = (np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))) + 1).astype(np.float32)
    x = _tfidf(x, weight)
    start = np.random.default_rng(seed).standard_normal((DIMS, min(rank + 8, len(x)))).astype(np.float32)
    q = np.linalg.qr(x @ start)[0]
    for _ in range(3):
        q = np.linalg.qr(x @ np.linalg.qr(x.T @ q)[0])[0]
    _, _, vt = np.linalg.svd(q.T @ x, full_matrices=False)
    axes = np.ascontiguousarray(vt[:rank].T)
    return Model(weight, axes, _unit(x @ axes), np.array([y for _, y in sample], np.float32))


def _nearest(cos: np.ndarray, k: int) -> np.ndarray:
    """The columns of each row's k largest values, of equal ones the first."""
    least = np.partition(cos, cos.shape[1] - k, axis=1)[:, cos.shape[1] - k]
    held = cos >= least[:, None]
    for i in np.flatnonzero(held.sum(axis=1) > k):
        even = np.flatnonzero(cos[i] == least[i])
        held[i, even[k - np.count_nonzero(cos[i] > least[i]):]] = False
    return np.nonzero(held)[1].reshape(-1, k)


def votes(b: Batch, m: Model, k: int = K) -> np.ndarray:
    """Weighted vote of each text's k most similar labelled rows."""
    if not len(m.labels):
        return np.full(len(b), 0.5)
    out = np.zeros(len(b))
    k = min(k, len(m.labels))
    v = _unit(_tfidf(counts(b), m.weight) @ m.axes)
    for lo in range(0, len(v), 256):
        cos = v[lo:lo + 256] @ m.vectors.T
        near = _nearest(cos, k)
        w = np.maximum(np.take_along_axis(cos, near, axis=1), 1e-6).astype(float) ** 8
        out[lo:lo + 256] = (w * m.labels[near]).sum(axis=1) / w.sum(axis=1)
    return out


def score(docs: DataFrame, model: Model, k: int = K, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score and predicted of every document; map only, with the model broadcast."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            p = np.clip(votes(parse(b.column("text")), held.value, k), 0, 1)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(p, pa.float64()), pa.array(p >= threshold, pa.bool_()).cast(pa.int32())], names=["doc_id", "score", "predicted"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, score double, predicted int"))
