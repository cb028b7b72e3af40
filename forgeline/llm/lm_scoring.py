"""Cross-entropy difference of two matched n-gram models.

The background model counts the words and word pairs of all documents, the target model those of the target
documents.  Both share one vocabulary (words that occur MIN_COUNT times or more; all others are one unknown word),
one order and one smoothing: pair counts, with Dirichlet weight PULL on the smoothed word probability.  A document's
score is the mean over its words of the target's log2 probability minus the background's: high scores look like the
target.  A document's own counts are taken out of both models before it is scored, so members of the target
gain nothing from having been counted.

Counts live in shards; blocks of documents ask for those of their distinct words, then of their distinct pairs.
Null and empty texts have no words: 0 words, and a score of 0.  Rows with a null doc_id are background only.  Rows with
equal doc_id are all target or none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgeline.llm.blocks import BLOB, SHARD_BYTES, Dealt, answered, blob_table, cuts, planes, replies, unplanes
from forgeline.llm.textbatch import mix64, parse, word_hashes

BLOCK_BYTES = 8 << 20
SCORED_WORDS = 1 << 17  # scored at a time: the arrays of that step follow them, or the longest document, and not the block
MIN_COUNT = 2
PULL = 4.0
ADD = 0.1
_UNKNOWN = np.uint64(0xD1B54A32D192ED03)
_KEY_BYTES = 6  # of a hash, beside its shard
_HEAD = 5       # numbers about the whole shard before each answer


def _blob(keys: np.ndarray, base: np.ndarray, target: np.ndarray, bits: int):
    """A part for every shard, empty ones too: each answer brings the shard's totals."""
    edge, low = cuts(keys, bits), keys << np.uint64(bits) >> np.uint64(64 - 8 * _KEY_BYTES)
    for s, (i, j) in enumerate(zip(edge[:-1], edge[1:])):
        yield s, planes(low[i:j].astype("<u8"), _KEY_BYTES) + planes(base[i:j].astype("<i8"), 4) + planes(target[i:j].astype("<i8"), 4)


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, sorted, and the number of each one's key."""
    order = np.argsort(keys)
    ordered = keys[order]
    first = np.ones(len(keys), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=first[1:])
    distinct = ordered[first]
    del ordered
    which = np.empty(len(keys), np.int32)
    which[order] = np.cumsum(first, dtype=np.int32) - 1
    return distinct, which


def _sums(blobs: list[bytes]) -> list[bytes]:
    width = _KEY_BYTES + 8
    size = [len(x) // width for x in blobs]
    key = np.concatenate([unplanes(x, n, "<u8", _KEY_BYTES) for x, n in zip(blobs, size)])
    counts = [np.concatenate([unplanes(x[(_KEY_BYTES + 4 * k) * n:], n, "<i8", 4) for x, n in zip(blobs, size)]) for k in (0, 1)]
    keys, which = _numbered(key)
    del key
    sums = [np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)]
    for total, own in zip(sums, counts):
        np.add.at(total, which, own)
    rare = sums[0] < MIN_COUNT
    head = np.array([(~rare).sum(), sums[0].sum(), sums[1].sum(), sums[0][rare].sum(), sums[1][rare].sum()], "<i8").tobytes()
    at = np.cumsum([0, *size])
    return [head + b"".join(planes(t[which[i:j]].astype("<i8")) for t in sums) for i, j in zip(at[:-1], at[1:])]


def _read(keys: np.ndarray, got: dict[int, bytes], bits: int):
    """Corpus counts (background, target) of the keys, and the totals over all shards."""
    edge = cuts(keys, bits)
    base, target, totals = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64), np.zeros(_HEAD, np.int64)
    for s, raw in got.items():
        i, j = edge[s], edge[s + 1]
        totals += np.frombuffer(raw, "<i8", _HEAD)
        raw = raw[8 * _HEAD:]
        base[i:j], target[i:j] = unplanes(raw, j - i, "<i8"), unplanes(raw[8 * (j - i):], j - i, "<i8")
    return base, target, totals


class _Texts:
    """The words of a block's documents, numbered, and which documents are target."""

    def __init__(self, table: pa.Table, got: pa.Table):
        chosen = {d for d, k in zip(got.column("doc_id").to_pylist(), got.column("kind").to_pylist()) if k == 0}
        self.batch = parse(table.column("text"))
        self.target = np.array([d is not None and d in chosen for d in table.column("doc_id").to_pylist()], bool)
        self.own = self.target[self.batch.doc]  # of each word
        self.keys, self.which = _numbered(word_hashes(self.batch))
        self.batch.data = self.batch.starts = self.batch.ends = None  # the words are numbers from here on

    def counts(self, which: np.ndarray, n: int, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.bincount(which, minlength=n), np.bincount(which[own], minlength=n)

    def with_words(self, got: pa.Table, bits: int) -> None:
        """Corpus counts of the words; words out of the vocabulary become one."""
        base, target, self.totals = _read(self.keys, replies(got, 1), bits)
        known = base >= MIN_COUNT
        self.base, self.tgt = np.where(known, base, self.totals[3]), np.where(known, target, self.totals[4])
        word = np.where(known, self.keys, _UNKNOWN)
        _, number = _numbered(word)
        self.number = number[self.which]  # of each word, the same for all words out of the vocabulary
        self.second = np.flatnonzero(self.batch.doc[1:] == self.batch.doc[:-1]) + 1  # words with one before
        pair = word[self.which[self.second]]
        pair = mix64(pair)
        pair += word[self.which[self.second - 1]] * np.uint64(0x9E3779B97F4A7C15)
        self.pairs, self.pair = _numbered(mix64(pair))

    def in_document(self, which: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """How often each one's own document has it."""
        _, place, times = np.unique(doc * (int(which.max(initial=0)) + 1) + which, return_inverse=True, return_counts=True)
        return times[place]

    def log_probability(self, word: np.ndarray, pair: np.ndarray, total: int, mine: np.ndarray, at: np.ndarray, once: np.ndarray, once_pair: np.ndarray, whole: np.ndarray) -> np.ndarray:
        """log2 probability of some words, with the document's own counts (where ``mine``) taken out; ``at``: those with one before."""
        count = word - once * mine
        p = (count + ADD) / (total - whole * mine + ADD * (self.totals[0] + 1))
        after = pair - once_pair * mine[at]
        p[at] = (after + PULL * p[at]) / (count[at - 1] + PULL)
        return np.log2(p)

    def scores(self, got: pa.Table, bits: int):
        """Bits for each word of every document, by the target and by the background; a few documents at a time."""
        base, target, _ = _read(self.pairs, replies(got, 2), bits)
        n, n_words = len(self.batch), self.batch.n_words
        bits_of = np.zeros((2, n))
        lo = 0
        while lo < n:
            hi = max(lo + 1, int(np.searchsorted(self.batch.first, self.batch.first[lo] + SCORED_WORDS, side="right")) - 1)
            i, j = self.batch.first[lo], self.batch.first[hi]
            a, b = np.searchsorted(self.second, (i, j))
            doc, which, pair, at = self.batch.doc[i:j] - lo, self.which[i:j], self.pair[a:b], self.second[a:b] - i
            once, once_pair, whole = self.in_document(self.number[i:j], doc), self.in_document(pair, doc[at]), n_words[lo:hi][doc]
            for k, (word, pairs, total, mine) in enumerate(((self.tgt, target, self.totals[2], self.own[i:j].astype(np.int64)), (self.base, base, self.totals[1], np.ones(j - i, np.int64)))):
                bits_of[k, lo:hi] = -np.bincount(doc, weights=self.log_probability(word[which], pairs[pair], total, mine, at, once, once_pair, whole), minlength=hi - lo)
            lo = hi
        return list(bits_of / np.maximum(n_words, 1))


_OUT = "doc_id long, n_words long, target_bits double, background_bits double, score double"


def cross_entropy_difference(docs: DataFrame, target: DataFrame, block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, n_words, bits for each word under either model, and their difference; target: doc_id of the target documents."""
    dealt = Dealt(docs, block_bytes, shard_bytes)
    bits = dealt.bits
    blk = dealt.block_of(F.xxhash64("doc_id"))
    blocks = dealt.docs.withColumn("blk", F.when(F.col("doc_id").isNull(), F.col("blk")).otherwise(blk)).groupBy("blk")
    chosen = (target.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
              .select(blk.alias("blk"), F.lit(0).alias("shard"), F.lit(0).alias("kind"), F.lit(None).cast("binary").alias("blob"), "doc_id"))

    def ask_words(key, table, got):
        if not table.num_rows:
            return blob_table(0, 1, iter(()))
        t = _Texts(table, got)
        return blob_table(key[0].as_py(), 1, _blob(t.keys, *t.counts(t.which, len(t.keys), t.own), bits))

    def ask_pairs(key, table, got):
        if not table.num_rows:
            return blob_table(0, 2, iter(()))
        t = _Texts(table, got)
        t.with_words(got, bits)
        return blob_table(key[0].as_py(), 2, _blob(t.pairs, *t.counts(t.pair, len(t.pairs), t.own[t.second]), bits))

    def finish(key, table, got):
        t = _Texts(table, got)
        if len(table):
            t.with_words(got, bits)
        h = t.scores(got, bits) if len(t.batch.doc) else [np.zeros(len(table))] * 2
        return pa.table([table.column("doc_id"), pa.array(t.batch.n_words, pa.int64()), *map(pa.array, h), pa.array(h[1] - h[0])],
                        names=["doc_id", "n_words", "target_bits", "background_bits", "score"])

    answers = lambda blobs, kind: answered(blobs, kind, _sums).withColumn("doc_id", F.lit(None).cast("long"))
    words = chosen.unionByName(answers(blocks.cogroup(chosen.groupBy("blk")).applyInArrow(ask_words, BLOB), 1))
    pairs = answers(blocks.cogroup(words.groupBy("blk")).applyInArrow(ask_pairs, BLOB), 2)
    return blocks.cogroup(words.unionByName(pairs).groupBy("blk")).applyInArrow(finish, _OUT)
