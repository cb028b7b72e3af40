"""Toxicity by compression distance.

Separate zstandard dictionaries are built from the labelled toxic and from the labelled ordinary texts: runs of words
from all over them, drawn by hash.  In addition, ordinary dictionaries are compared with the same and the
passages that mark toxic documents: the runs of byte n-grams that are far more frequent in toxic documents than in
others, of which the longest-lived cores are kept, so that ordinary text gains nothing from them.  A document is cut
into windows of a few words, every window is compressed with the dictionaries, and the differences of the lengths
(largest ones, share above the noise; of either kind) are turned into a score by a logistic regression on labelled
documents that the dictionaries have not seen.

The fit takes at most FIT_ROWS labelled documents of each class, those of the smallest hashes, of at most
FIT_BYTES bytes each; its labels' whole-table shares set the score's level.  Scoring covers every
window of every whole text.  Null and empty texts have no window: their differences are 0, and they get that
score.  Null labels and null doc_ids take no part in the fit.  With one class only, the score is its share.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 6
GRAMS = (5, 7, 9)  # bytes of the n-grams, a word's edges included
BASE_BYTES = 40_000
DRAWN = 12  # words of a run
PAIRS = 2  # of dictionaries with passages, with other ordinary text each; their gains are averaged
LEVEL = 3
THRESHOLD = 0.3
_TRIM = b".,!?;:"


def words(text: bytes) -> list[bytes]:
    return text.lower().split()


def windows(ws: list[bytes], size: int = WINDOW) -> list[bytes]:
    """Windows of ``size`` words, each half over the next: every word is in two."""
    half = size // 2
    return [b" " + b" ".join(ws[max(0, i):i + size]) + b" " for i in range(-half, len(ws), half)]


def _grams(w: bytes) -> list[tuple[int, bytes]]:
    """(place, n-gram) of a word with its edges."""
    s = b" " + w.strip(_TRIM) + b" "
    return [(i, s[i:i + n]) for n in GRAMS for i in range(len(s) - n + 1)]


def marking_passages(toxic: list[bytes], ordinary: list[bytes], least: int = 4, least_share: float = 0.01, ratio: float = 10.0) -> list[bytes]:
    """Passages of words that mark toxic documents, rarest first (the end of a dictionary is the cheapest to refer to)."""
    least = max(least, int(least_share * len(toxic)))
    in_toxic, in_other, vocabulary = Counter(), Counter(), Counter()
    for texts, count in ((toxic, in_toxic), (ordinary, in_other)):
        for t in texts:
            own = set(words(t))
            count.update({g for w in own for _, g in _grams(w)})
            if count is in_toxic:
                vocabulary.update(own)
    nt, no = max(1, len(toxic)), max(1, len(ordinary))
    marks = {g for g, c in in_toxic.items() if c >= least and (c + 0.5) / nt >= ratio * (in_other[g] + 0.5) / no}
    found: Counter = Counter()
    for w, c in vocabulary.items():
        gs = _grams(w)
        best = max((in_toxic[g] for _, g in gs if g in marks), default=0)
        if not best:
            continue
        s = b" " + w.strip(_TRIM) + b" "
        held = np.zeros(len(s) + 1, bool)  # the word's bytes in n-grams about as common as its best one
        for i, g in gs:
            if g in marks and 2 * in_toxic[g] >= best:
                held[i:i + len(g)] = True
        edges = np.flatnonzero(np.diff(held.astype(np.int8), prepend=0)).tolist()
        for lo, hi in zip(edges[::2], edges[1::2]):
            found[s[lo:hi]] += c
    passages = [p for p, c in sorted(found.items(), key=lambda x: (x[1], x[0])) if c >= least]
    # a passage counts wherever it stands in a text, as it does for a dictionary
    spread = [[b" " + b" ".join(words(t)) + b" " for t in texts] for texts in (toxic, ordinary)]
    share = [[sum(p in t for t in texts) / max(1, len(texts)) for p in passages] for texts in spread]
    return [p for p, a, b in zip(passages, *share) if a >= ratio * (b + 0.5 / no)]


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    p = zstandard.ZstdCompressionParameters.from_level(LEVEL, write_content_size=0, write_checksum=0, write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS)
    d.precompute_compress(compression_params=p)
    return zstandard.ZstdCompressor(dict_data=d, compression_params=p)


def _lengths(c: zstandard.ZstdCompressor, parts: list[bytes]) -> np.ndarray:
    size = np.array([len(x) for x in parts], "<u8")
    place = np.column_stack([np.cumsum(size) - size, size]).astype("<u8").tobytes()
    out = c.multi_compress_to_buffer(zstandard.BufferWithSegments(b"".join(parts), place))
    return np.array([len(x) for x in out], np.int64)


def differences(groups: list[list], texts: list[bytes], most: int = 65536) -> np.ndarray:
    """Per text and group: largest, second and third largest gain of the toxic dictionaries, log of the gains over 4, share of such windows.

    groups: of (ordinary, toxic) compressors, whose gains are averaged.  Half a window's gain is that of the two windows that hold it: a
    marking passage shows in both.
    """
    out = np.zeros((len(texts), 5 * len(groups)))
    tools = {id(c): c for pairs in groups for pair in pairs for c in pair}
    held: list[bytes] = []
    where: list[int] = []
    gains: list[np.ndarray] = []

    def flush():
        if held:
            size = {k: _lengths(c, held) for k, c in tools.items()}
            gains.append(np.column_stack([np.mean([size[id(o)] - size[id(t)] for o, t in pairs], axis=0) for pairs in groups]))
            held.clear()

    for i, t in enumerate(texts):
        own = windows(words(t))
        where += [i] * len(own)
        for lo in range(0, len(own), most):
            held += own[lo:lo + most]
            if len(held) >= most:
                flush()
    flush()
    if where:
        every, doc = np.concatenate(gains), np.array(where)
        both = doc[1:] == doc[:-1]  # a text with words has two windows at least
        every, doc = (every[1:] + every[:-1])[both], doc[1:][both]
        first = np.searchsorted(doc, np.arange(len(texts) + 1))
        n = np.diff(first)
        for g in range(len(groups)):
            gain, own = every[:, g], out[:, 5 * g:5 * g + 5]
            gain = gain[np.lexsort((-gain, doc))]
            for j in range(3):
                has = n > j
                own[has, j] = np.maximum(gain[first[:-1][has] + j], 0)
            over = np.bincount(doc, weights=np.maximum(gain - 4, 0), minlength=len(texts))
            own[:, 3], own[:, 4] = np.log1p(over), over / np.maximum(n, 1)
    return out


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton's method; the last is the intercept."""
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(a.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (weight * p * (1 - p))[:, None]).T @ a + np.diag(penalty), a.T @ (weight * (y - p)) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass
class Model:
    dictionaries: list[list[tuple[bytes, bytes]]]  # groups of (ordinary, toxic)
    weights: np.ndarray
    share: float

    def compressors(self) -> list[list]:
        made = {d: _compressor(d) for group in self.dictionaries for pair in group for d in pair}
        return [[(made[o], made[t]) for o, t in group] for group in self.dictionaries]


def _drawn_text(texts: list[bytes], part: int, size: int) -> bytes:
    """Runs of words from all over the texts, those of the smallest hashes; other ones for every part."""
    runs = {b" ".join(ws[i:i + DRAWN]) for ws in map(words, texts) for i in range(0, len(ws), DRAWN)}
    return b" ".join(sorted(runs, key=lambda r: (zlib.crc32(r, 0x51 + part), r))[:size // 2])[:size]


def fit(sample: list[tuple[bytes, int]], share: float, base_bytes: int = BASE_BYTES) -> Model:
    """Dictionaries from two thirds of the sample, thresholds of the differences from the rest."""
    learn, rest = [s for i, s in enumerate(sample) if i % 3], [s for i, s in enumerate(sample) if i % 3 == 0]
    toxic, ordinary = [t for t, y in learn if y], [t for t, y in learn if not y]
    y = np.array([y for _, y in rest], float)
    if not toxic or not ordinary or not 0 < y.sum() < len(y):
        return Model([], np.zeros(0), share)
    passages = b"".join(marking_passages(toxic, ordinary))
    bases = [_drawn_text(ordinary, i, base_bytes) for i in range(PAIRS)]
    tails = [base[:64] or b" " * 64 for base in bases]  # zstandard does not index a dictionary's last bytes
    apart = _drawn_text(toxic, 0, base_bytes)
    model = Model([[(base + tail, base + passages + tail) for base, tail in zip(bases, tails)],
                   [(bases[0] + tails[0], apart + (apart[:64] or tails[0]))]], np.zeros(0), share)
    x = differences(model.compressors(), [t for t, _ in rest])
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    model.weights = logistic(x, y, weight)
    return model


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score and predicted of every document; map only."""
    def run(batches):
        tools = model.compressors() if len(model.weights) else None
        for b in batches:
            texts = [(t or "").encode() for t in b.column("text").to_pylist()]
            if tools is None:
                p = np.full(len(texts), model.share)
            else:
                x = differences(tools, texts)
                p = 1 / (1 + np.exp(-np.clip(x @ model.weights[:-1] + model.weights[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(p, pa.float64()), pa.array(p >= threshold, pa.bool_()).cast(pa.int32())], names=["doc_id", "score", "predicted"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, score double, predicted int"))
