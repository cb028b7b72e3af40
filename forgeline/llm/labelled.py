"""Bounded, reproducible samples of labelled documents to fit classifiers on."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIT_ROWS = 3000    # of each class
FIT_BYTES = 65536  # of a text


def crc(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary"))


def fit_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, rows: int = FIT_ROWS, most_bytes: int = FIT_BYTES):
    """Up to ``rows`` labelled texts of each class, [(text, label)] in hash order, and the share of label 1 in all rows to learn from.

    Texts of more than ``most_bytes`` are no part of the fit; the sample is filled up with others.  Rows of labels with one doc_id
    and different labels contradict each other and are left out; of documents with one doc_id, the smallest text counts.
    """
    own = (labels.where(learn & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).where("label in (0, 1)")
           .groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("most")).where("label = most").drop("most"))
    counts = {r["label"]: r["n"] for r in own.groupBy("label").agg(F.count("*").alias("n")).collect()}  # two rows
    usable = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(F.col("text").cast("string")).alias("size"))
              .where(F.col("size") <= most_bytes).select("doc_id").distinct())
    own = own.join(usable, "doc_id", "left_semi").checkpoint()
    picked = None
    for value in (0, 1):
        part = own.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        picked = part if picked is None else picked.unionByName(part)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(F.octet_length("text") <= most_bytes)
    got = (texts.join(F.broadcast(picked), "doc_id")  # 2 * rows ids at most
           .groupBy("doc_id", "label").agg(F.min("text").alias("text")).toPandas())
    # an order that has nothing to do with the ids, the same on every run
    order = np.argsort([hash_order(i) for i in got["doc_id"]], kind="stable") if len(got) else []
    return [(got["text"].iloc[i].encode(), int(got["label"].iloc[i])) for i in order], counts.get(1, 0) / max(1, sum(counts.values()))


def hash_order(i: int) -> int:
    return (int(i) * 0x9E3779B97F4A7C15 + 0x1234567) % (1 << 64) * 0xBF58476D1CE4E5B9 % (1 << 64)
