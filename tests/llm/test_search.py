"""Ranked lexical search against a plain computation."""

import math
import re
from collections import Counter

import pyarrow as pa
import pytest

from corpus_fixture import corpus, corpus_rows, nothing  # noqa: F401

from forgeline.llm import bag_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_search(rows, items, k=10):
    docs = [(d, Counter(terms(t))) for d, t in rows]
    docs = [(d, c) for d, c in docs if c]
    n, total = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c in docs:
            m = 10 + (90 * sum(c.values()) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if t in c)
            if score > 0:
                scores.append((-score, d is None, d or 0))
        out += [(item, i + 1, None if null else d, -s) for i, (s, null, d) in enumerate(sorted(scores)[:k])]
    return Counter(out)


ITEMS = [(1, "the of AND to in a; is that"), (2, "ERON tion-ing reanti thst the"), (3, "again and xyzzy page 7 of"), (4, None), (5, ""), (6, "漢字 ñandú ßtraße éàü"),
         (7, "!!! ..."), (8, "xyzzy"), (1, "one words two"), (None, "one two"), (9, "x" * 20000), (10, "again and"), (10, "again and")]


@pytest.mark.parametrize("k,item_rows", [(10, 512), (3, 2)])
def test_search(spark, corpus, corpus_rows, k, item_rows):
    rows = corpus_rows + [(r[0] + 2000 if i % 2 else 12, r[1], *r[2:]) for i, r in enumerate(corpus_rows[:30]) if r[0] is not None]
    docs = spark.createDataFrame(rows, corpus.schema).repartition(5, "blk")
    items = spark.createDataFrame([(i, t, 0.5, 3) for i, t in ITEMS], "item_id long, text string, score double, rank int")
    got = bag_search.search(docs, items, k=k, item_rows=item_rows)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert Counter(map(tuple, got.collect())) == brute_search([(r[0], r[1]) for r in rows], ITEMS, k)


def test_long_text_and_copies(spark):
    """A text of over 1 MB, and a class of copies larger than k: its smallest ids come first."""
    rows = [(5000 - i, "alpha beta beta") for i in range(60)] + [(7000, "alpha " * 200_000), (7001, "gamma"), (3, "Alpha BETA beta.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    items = [(1, "alpha"), (2, "beta gamma")]
    got = bag_search.search(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert Counter(map(tuple, got)) == brute_search(rows, items)
    assert [r["doc_id"] for r in sorted(got) if r["item_id"] == 2] == [7001, 3, *range(4941, 4949)]


def test_a_class_is_scored_once(spark):
    docs = spark.createDataFrame([(i, f"alpha beta {'rest' if i % 2 else 'else'}") for i in range(40)] + [(99, "alpha alpha other words here")], "doc_id long, text string")
    vocabulary = bag_search.Vocabulary.of(bag_search.terms(pa.array(["alpha Beta"])))
    rows = bag_search.bags(docs, vocabulary).selectExpr("doc_id", "n as m", "bag", "xxhash64(bag, n) as h")
    assert sorted((r["members"], r["first"]) for r in bag_search.classes(rows).collect()) == [(1, 99), (40, 0)]


def test_clashing_hashes_are_verified(spark):
    """Two classes with one hash stay apart, and so do words with the hash of a term."""
    rows = spark.createDataFrame([(1, 20, bytearray(b"aaaaaaaa"), 7), (2, 20, bytearray(b"bbbbbbbb"), 7), (3, 21, bytearray(b"aaaaaaaa"), 7)], "doc_id long, m long, bag binary, h long")
    assert bag_search.classes(rows).count() == 3
    b = bag_search.terms(pa.array(["alpha beta gamma"]))
    v = bag_search.Vocabulary.of(b)
    v.data = v.data.copy()
    v.data[v.starts[0]] ^= 1
    word, term = v.find(b)
    assert len(word) == 2 and 0 not in term


def test_weights_beyond_doubles(spark, monkeypatch):
    """The whole-number way gives the same scores."""
    docs = spark.createDataFrame([(i, f"alpha {'beta ' * (i % 5)} gamma{i % 3}") for i in range(30)], "doc_id long, text string")
    items = [(1, "alpha beta"), (2, "gamma1 beta")]
    monkeypatch.setattr(bag_search, "EXACT", 1)
    got = bag_search.search(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert Counter(map(tuple, got)) == brute_search([(r["doc_id"], r["text"]) for r in docs.collect()], items)


def test_empty_tables(spark, corpus, nothing):
    some, none = spark.createDataFrame([(1, "the of")], "item_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert bag_search.search(nothing, some).count() == 0 and bag_search.search(corpus, none).count() == 0
