"""Ranked lexical search with bag deduplication.

Terms are maximal runs of ASCII letters and digits and of all characters beyond ASCII; only A-Z are lower-cased.  A document's
score for an item depends on its length class m and on how often it has the item's terms, and on nothing else.  So
documents are restricted to the items' vocabulary, and those with an identical bag (the term frequencies of that
vocabulary) and m are one class, which is scored once:

1. Items are dealt into blocks of bounded size; each block is a query set of its own, put to all rows.
2. One pass over the texts writes each document's length and bag, a short binary string of (term, frequency) pairs.
3. Documents are grouped by a hash of (bag, m) and verified by the bag itself, so that clashing hashes stay apart.
   A class keeps its size, for document frequencies, and its smallest doc_id.
4. Classes are scored by exact integer products; every task keeps the best k classes of each item, ordered by score and
   smallest doc_id: an item's best k documents lie in its best k classes.
5. Those classes are expanded by ascending doc_id (each gives its k smallest), and each item keeps the best k documents.

Null and empty texts have no terms: they count nowhere and never rank.  Null doc_ids rank after all others of their score.
Every row of documents is a document, and every row of the items an item, repeated ids and rows included; items without
text have no results, and neither do empty tables.  Other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forgeline.llm.textbatch import Batch, parse, word_hashes
from forgeline.session import drop_scratch, scratch_path

ITEM_ROWS = 512          # of a block
ITEM_BYTES = 1 << 17
SCORE_CELLS = 8_000_000  # of the frequency matrix held at once
EXACT = 1 << 53          # whole numbers below it add exactly as doubles
RANKS = "item_id long, rank int, doc_id long, score long"

_GAP = np.ones(256, dtype=bool)
_GAP[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_PAIR = np.dtype([("term", "<u4"), ("tf", "<u4")])


def terms(col) -> Batch:
    """The terms of every text of a column."""
    return parse(col, lower=True, gap=_GAP)


@dataclass
class Vocabulary:
    """The distinct terms of a block's items, ordered by hash; spelled one after the other in data."""

    hashes: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    data: np.ndarray

    @classmethod
    def of(cls, b: Batch) -> Vocabulary:
        hashes, at = np.unique(word_hashes(b), return_index=True)
        sizes = (b.ends - b.starts)[at]
        words = [b.data[s:s + n] for s, n in zip(b.starts[at], sizes)]
        return cls(hashes, np.cumsum(sizes) - sizes, sizes, np.concatenate(words) if words else np.zeros(0, np.uint8))

    def find(self, b: Batch) -> tuple[np.ndarray, np.ndarray]:
        """Which words of a batch are terms of the vocabulary, and which ones; hashes are verified by spelling."""
        if not len(self.hashes) or not len(b.starts):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        hashes = word_hashes(b)
        term = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        word = np.flatnonzero((self.hashes[term] == hashes) & (self.sizes[term] == b.ends - b.starts))
        term = term[word]
        size = self.sizes[term]
        at = np.cumsum(size) - size
        within = np.arange(size.sum()) - np.repeat(at, size)
        other = b.data[within + np.repeat(b.starts[word], size)] != self.data[within + np.repeat(self.starts[term], size)]
        same = np.add.reduceat(other, at) == 0 if len(at) else np.zeros(0, bool)
        return word[same], term[same]


def _bags(vocabulary: Vocabulary):
    def run(batches):
        for rows in batches:
            b = terms(rows.column("text"))
            word, term = vocabulary.find(b)
            size = max(1, len(vocabulary.hashes))
            key, tf = np.unique(b.doc[word] * size + term, return_counts=True)
            pairs = np.zeros(len(key), _PAIR)
            pairs["term"], pairs["tf"] = key % size, tf
            edge = np.searchsorted(key // size, np.arange(len(b) + 1))
            bags = [pairs[i:j].tobytes() for i, j in zip(edge[:-1], edge[1:])]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(b.n_words.astype(np.int64)), pa.array(bags, pa.binary())],
                                             names=["doc_id", "n", "bag"])
    return run


def bags(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, n (terms, with repeats) and bag of every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_bags(vocabulary), "doc_id long, n long, bag binary")


def length_class(n_docs: int, n_terms: int) -> Column:
    """m = 100 - 90 + (90 * n * N) div L"""
    return F.expr(f"10L + (90L * n * {n_docs}L) div {max(1, n_terms)}L")


def classes(rows: DataFrame) -> DataFrame:
    """h, m, bag, members, first (smallest doc_id) of the documents with equal bags and m; bags without terms have no class."""
    return (rows.where(F.octet_length("bag") > 0).groupBy("h", "m", "bag")
            .agg(F.count("*").alias("members"), F.min("doc_id").alias("first")))


def _unpack(bag: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of some bags, and the bag of each."""
    raw = bag.to_pylist()
    return np.frombuffer(b"".join(raw), _PAIR), np.repeat(np.arange(len(raw)), [len(x) // _PAIR.itemsize for x in raw])


def document_frequencies(found: DataFrame, size: int) -> np.ndarray:
    """How many documents hold each term of the vocabulary."""
    def run(batches):
        for rows in batches:
            pairs, which = _unpack(rows.column("bag"))
            df = np.zeros(size, np.int64)
            np.add.at(df, pairs["term"], rows.column("members").to_numpy()[which])
            some = np.flatnonzero(df)
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(df[some])], names=["term", "df"])

    df = np.zeros(size, np.int64)
    for r in found.select("bag", "members").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r["term"]] = r["df"]  # one row for a term of a bounded block
    return df


def term_weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)


def _best(weights: np.ndarray, item_terms: list[np.ndarray], k: int):
    """Scores of a task's classes for all items; the best k classes of each item leave the task."""
    has = np.zeros((len(weights), len(item_terms)))
    for i, own in enumerate(item_terms):
        has[own, i] = 1
    exact = all(int(weights[own].sum()) * 1_000_000 < EXACT for own in item_terms)  # a term adds at most w * 10^6
    step = max(1, SCORE_CELLS // max(1, len(weights)))

    def scored(pairs, which, m, n):
        tf = pairs["tf"].astype(np.int64)
        value = weights[pairs["term"]] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[which]))
        if not exact:
            out = np.zeros((n, len(item_terms)), np.int64)
            for i in range(len(item_terms)):
                own = has[pairs["term"], i] > 0
                np.add.at(out[:, i], which[own], value[own])
            return out
        dense = np.zeros((n, len(weights)))
        dense[which, pairs["term"]] = value
        return (dense @ has).astype(np.int64)

    def run(batches):
        kept = np.zeros((5, 0), np.int64)  # item, score, class, is its first doc_id null, that doc_id
        least = np.ones(len(item_terms), np.int64)
        for whole in batches:
            for lo in range(0, whole.num_rows, step):
                rows = whole.slice(lo, step)
                pairs, which = _unpack(rows.column("bag"))
                score = scored(pairs, which, rows.column("m").to_numpy(), rows.num_rows)
                row, item = np.nonzero(score >= least)
                first = rows.column("first")
                null, first = first.is_null().to_numpy(zero_copy_only=False), first.fill_null(0).to_numpy()
                kept = np.concatenate([kept, [item, score[row, item], rows.column("class").to_numpy()[row], null[row], first[row]]], axis=1)
                kept = kept[:, np.lexsort((kept[4], kept[3], -kept[1], kept[0]))]
                edge = np.searchsorted(kept[0], np.arange(len(item_terms) + 1))
                place = np.arange(kept.shape[1]) - edge[kept[0]]
                full = np.flatnonzero(np.diff(edge) >= k)
                least[full] = kept[1, edge[full] + k - 1]
                kept = kept[:, place < k]
        yield pa.RecordBatch.from_arrays([pa.array(kept[0].astype(np.int32)), pa.array(kept[1]), pa.array(kept[2]), pa.array(kept[4], mask=kept[3] > 0)],
                                         names=["item", "score", "class", "first"])
    return run


def _search_block(docs: DataFrame, items: list, k: int, out: str) -> None:
    """Append the ranks of a block's items to the table at out."""
    spark = docs.sparkSession
    b = terms(pa.array([r["text"] for r in items], pa.string()))
    vocabulary = Vocabulary.of(b)
    size = len(vocabulary.hashes)
    at = np.searchsorted(vocabulary.hashes, word_hashes(b))
    item_terms = [np.unique(at[i:j]) for i, j in zip(b.first[:-1], b.first[1:])]

    bag_path, class_path = scratch_path(spark, "bags"), scratch_path(spark, "bag-classes")
    bags(docs, vocabulary).write.parquet(bag_path)
    rows = spark.read.parquet(bag_path)
    total = rows.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.sum("n").alias("terms")).first()
    m = length_class(total["docs"], total["terms"] or 0)
    rows = rows.where("n > 0").select("doc_id", m.alias("m"), "bag").select("doc_id", "m", "bag", F.xxhash64("bag", "m").alias("h"))
    classes(rows).withColumn("class", F.monotonically_increasing_id()).write.parquet(class_path)
    found = spark.read.parquet(class_path)
    weights = term_weights(document_frequencies(found, size), total["docs"])

    place = Window.partitionBy("item").orderBy(F.desc("score"), F.col("first").asc_nulls_last())
    best = (found.select("class", "m", "bag", "first").mapInArrow(_best(weights, item_terms, k), "item int, score long, class long, first long")
            .withColumn("at", F.row_number().over(place)).where(F.col("at") <= k).select("item", "score", "class").checkpoint())
    asked = found.select("class", "h", "m", "bag").join(F.broadcast(best.select("class").distinct()), "class")  # at most k for each item of a block
    asked = asked.checkpoint()
    smallest = Window.partitionBy("h", "m", "bag").orderBy(F.col("doc_id").asc_nulls_last())
    members = (rows.join(F.broadcast(asked.select("h").distinct()), "h", "left_semi")
               .withColumn("at", F.row_number().over(smallest)).where(F.col("at") <= k).select("h", "m", "bag", "doc_id"))
    rank = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(items)], "item int, item_id long")
    (best.join(members.join(asked, ["h", "m", "bag"]).select("class", "doc_id"), "class")
     .withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)
     .join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score").write.mode("append").parquet(out))
    for path in (bag_path, class_path):
        drop_scratch(spark, path)


def search(docs: DataFrame, items: DataFrame, k: int = 10, item_rows: int = ITEM_ROWS, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """item_id, rank (from 1), doc_id, score of the k best documents of every item whose score is above 0."""
    spark = docs.sparkSession
    items = (items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
             .where(F.octet_length("text") > 0).withColumn("row", F.monotonically_increasing_id()).checkpoint())
    total = items.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("size")).first()
    n_blocks = max(1, -(-total["n"] // item_rows), -(-(total["size"] or 0) // item_bytes))
    out = scratch_path(spark, "ranks")
    spark.createDataFrame([], RANKS).write.parquet(out)
    for block in range(n_blocks):
        own = items.where(F.pmod(F.xxhash64("row"), F.lit(n_blocks)) == block).collect()
        if own:
            _search_block(docs, own, k, out)
    return spark.read.schema(RANKS).parquet(out)
