"""Substring dedup, n-gram join and line dedup against brute force."""

import hashlib
import random
import re
from collections import Counter

import brute
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from corpus_fixture import corpus, corpus_rows, nothing  # noqa: F401

from forgeline.llm import line_templates, ngram_join, oracle, substring_dedup


def rows_of(corpus_rows):
    return [(r[0], r[1]) for r in corpus_rows]


@pytest.mark.parametrize("block_bytes,shard_bytes", [(1 << 22, 1 << 24), (3000, 9000)])
def test_substring_dedup(corpus, corpus_rows, block_bytes, shard_bytes):
    got = substring_dedup.remove_repeats(corpus, block_bytes=block_bytes, shard_bytes=shard_bytes).collect()
    want = [(d, " ".join(w), n, gone) for d, w, n, gone in brute.remove_repeats(rows_of(corpus_rows))]
    assert Counter(tuple(r) for r in got) == Counter(want)
    assert sum(w[3] for w in want) > 1000


def test_substring_dedup_keeps_columns(corpus, corpus_rows):
    got = substring_dedup.without_repeats(corpus)
    assert got.schema.names == corpus.schema.names
    want = Counter((d, len(w)) for d, w, n, gone in brute.remove_repeats(rows_of(corpus_rows)) if not gone or gone < n)
    assert Counter((r["doc_id"], len(brute.words(r["text"]))) for r in got.collect()) == want


def test_automata_are_split():
    word = np.array([1, 2, 3, 4, 5, 1, 2, 3, 4, 5, 9], np.int64)
    phrases = [np.array(p) for p in ([1, 2, 3], [2, 3, 4], [3, 4, 5], [1, 2, 3, 4, 5])]
    for most in (1, 4, 100):
        hits = sorted(substring_dedup.locate(word, np.array([0, 5, 11]), [7, 8], phrases, [1, 7, 8, 9], most))
        assert hits == [(0, 0, 3), (1, 0, 3), (1, 1, 4)]


def test_a_run_that_earlier_documents_hold_in_parts(spark):
    """Each window of the last text is in an earlier one, but no earlier one holds the whole; repeats within a text are none."""
    w = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(w[:30])), (2, " ".join(["x"] * 40)), (3, " ".join(w[18:60])), (4, " ".join(w)), (0, " ".join(w[5:25])), (5, " ".join(["x"] * 15))]
    got = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), block_bytes=300).collect()
    assert sorted((r["doc_id"], r["kept_text"]) for r in got) == sorted((d, " ".join(k)) for d, k, _, _ in brute.remove_repeats(rows))


@pytest.mark.parametrize("block_bytes,shard_bytes", [(1 << 22, 1 << 24), (3000, 9000)])
def test_ngram_join(corpus, corpus_rows, block_bytes, shard_bytes):
    got = ngram_join.join_components(corpus, block_bytes, shard_bytes).collect()
    want = brute.join_components(rows_of(corpus_rows))
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == Counter((d, n, c) for (d, _), (n, c) in zip(rows_of(corpus_rows), want))
    assert sum(d != c for (d, _), (_, c) in zip(rows_of(corpus_rows), want) if d is not None) > 15


def test_ngram_join_star_of_near_copies(spark):
    """Copies that differ from the first in other words each: linked with it, not with one another."""
    base = [f"w{i}" for i in range(120)]
    rows = [(0, " ".join(base))]
    for i in range(1, 60):
        w = list(base)
        w[(i * 2) % 120], w[(i * 2 + 37) % 120] = f"x{i}", f"y{i}"
        rows.append((i, " ".join(w)))
    rows += [(100 + i, " ".join(f"u{i}_{j}" for j in range(50)) + " " + " ".join(base[:30])) for i in range(30)]
    want = brute.join_components(rows)
    for seed in (0, 1):  # the least doc_id need not be the leader
        shuffled = [((d * 37 + seed) % 211, t) for d, t in rows]
        got = ngram_join.join_components(spark.createDataFrame(shuffled, "doc_id long, text string"), 4000, 9000).collect()
        assert Counter((r["doc_id"], r["component_id"]) for r in got) == Counter((d, c) for (d, _), (_, c) in zip(shuffled, brute.join_components(shuffled)))
    assert sum(c == 0 for _, c in want) > 50


@pytest.mark.parametrize("chunk_nodes", [512, 7])
def test_ngram_join_counts_every_link(spark, monkeypatch, corpus, corpus_rows, chunk_nodes):
    monkeypatch.setattr(ngram_join.link_counts, "__defaults__", (chunk_nodes, 2_000_000))
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(base[:i] + [f"x{i}"] + base[i + 1:])) for i in range(40)] + [(40, " ".join(["x0", *base[1:]])), (41, "alone here with a few words")]
    for docs, pairs in ((spark.createDataFrame(rows, "doc_id long, text string"), rows), (corpus, rows_of(corpus_rows))):
        sets = [brute.shingles(t) if d is not None else frozenset() for d, t in pairs]
        others = set(sets) - {frozenset()}
        links = {s: sum(s != x and 100 * len(s & x) >= 80 * len(s | x) for x in others) for s in others}
        got = ngram_join.join_components(docs, 4000, 9000).collect()
        assert Counter((r["doc_id"], r["n_shingles"], r["n_links"]) for r in got) == Counter((d, len(brute.shingles(t)), links.get(s, 0)) for (d, t), s in zip(pairs, sets))
    assert len(rows) == 42


def test_one_of_each(corpus, corpus_rows):
    got = ngram_join.one_of_each(corpus)
    assert got.schema.names == corpus.schema.names
    out = {d for (d, _), (_, c) in zip(rows_of(corpus_rows), brute.join_components(rows_of(corpus_rows))) if d is not None and d != c}
    assert Counter(r["doc_id"] for r in got.select("doc_id").collect()) == Counter(d for d, _ in rows_of(corpus_rows) if d not in out)


@pytest.mark.parametrize("min_docs", [2, 10])
def test_line_dedup(corpus, corpus_rows, min_docs):
    got = line_templates.drop_lines(corpus, min_docs=min_docs).collect()
    rows = rows_of(corpus_rows)
    want = [(d, *x) for (d, _), x in zip(rows, brute.drop_lines(rows, min_docs=min_docs))]
    assert Counter((r["doc_id"], r["kept_text"], r["n_lines"], r["n_dropped"]) for r in got) == Counter(want)
    assert sum(w[3] for w in want) > 10


def test_line_dedup_generalises(spark):
    lines = [f"Posted by {name} in the daily news section" for name in "ann bob cid dot eve flo gus hal ivy jon kay lou".split()]
    docs = spark.createDataFrame([(i, x + f"\nown{i} text{i} here{i}") for i, x in enumerate(lines)], "doc_id long, text string")
    got = {r["doc_id"]: r["n_dropped"] for r in line_templates.drop_lines(docs).collect()}
    assert got == {i: int(i > 0) for i in range(12)}


@pytest.mark.parametrize("others", [0, 500, 5000])
def test_line_dedup_in_a_crowded_leaf(spark, others):
    """A template with a variable name, beside many times its lines in the same leaf."""
    rng = random.Random(others)
    name = lambda i: "".join(chr(97 + i // 26 ** k % 26) for k in range(4))
    lines = [f"Read more from {name(i)} on our daily news site" for i in range(40)]
    # other lines share common words by chance; a second template shares a token with the first
    lines += [" ".join(["Read more from", *(rng.choice(["of", "on", "the"]) if rng.random() < 0.2 else name(rng.randrange(10**5)) for _ in range(6))]) for _ in range(others)]
    lines += [f"Read more from {name(i)} on a big farm today" for i in range(others // 10)]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["n_dropped"] for r in line_templates.drop_lines(docs).collect()}
    assert [got[i] for i in range(40)] == [0] + [1] * 39
    assert not any(got[i] for i in range(40, 40 + others))
    assert sum(got[i] for i in range(40 + others, len(lines))) == max(0, others // 10 - 1)


def planted_lines():
    """Crowded leaves, short lines, templates met by chance, and templates of variable words."""
    rng = random.Random(6)
    name = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6))
    docs = []
    for i in range(60):
        lines = [f"Posted by user {name()} in this group on our board today", f"All rights reserved {name()}", f"a b c {name()}"]
        lines += [f"Posted by user {name()} {name()} {name()} {name()} {name()} {name()} {name()} {name()}" for _ in range(10)]
        lines += [f"The quick brown {name()} jumps over the {rng.choice(['lazy', 'sleepy', 'tired'])} dog", f"one two three {rng.choice('uvwxyz')} {rng.choice('uvwxyz')} {rng.choice('uvwxyz')}",
                  f"see page {i} for {name()} and more of it", "exactly the same line here", name()]
        rng.shuffle(lines)
        docs.append((i * 2 + 1, "\n".join(lines)))
    return docs


def test_line_dedup_one_rule_everywhere(spark):
    """The operator, its SQL and the plain version agree where templates of variable words are dropped."""
    rows = planted_lines()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: (r["kept_text"], r["n_lines"], r["n_dropped"]) for r in line_templates.drop_lines(docs).collect()}
    want = dict(zip((d for d, _ in rows), brute.drop_lines(rows)))
    assert got == want
    lost = [x for d, t in rows for x in t.split("\n") if x not in want[d][0].split("\n")]
    assert sum(x.startswith("Posted by user") for x in lost) == 59 and sum("in this group" in x for x in lost) == 59
    assert sum(x.startswith("The quick") for x in lost) == 57 and not any(x.startswith("a b c") for x in lost)
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", rows)
    sql = {r[0]: r[1:] for r in con.execute(oracle.SQL["op5_line_dedup"]).fetchall()}
    assert sql == {d: (n, k, hashlib.sha256(t.encode()).hexdigest()) for d, (t, n, k) in want.items()}


def test_line_dedup_needs_more_than_the_leading_tokens(spark):
    words = "ann bob cid dot eve flo gus hal ivy jon kay lou".split()
    lines = [f"It was the {w}" for w in words] + [f"It was the {w} x{chr(97 + i)} y{w}" for i, w in enumerate(words)]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    assert not any(r["n_dropped"] for r in line_templates.drop_lines(docs).collect())


def test_line_tokens_of_odd_lines(spark):
    """Spacing and masking agree with the plain version, also on long words and characters outside the first plane."""
    rng = random.Random(8)
    parts = [" ", "  ", "\t", "\r", "\x0b", "\x0c", "\xa0", "\u2003", "\x85", "\x1f", "a", "é", "漢", "\U0001f600", "7", "٣", "@", ":", "/", "://", ":/", "http://x", "<*>", "$1", "\\", "word"]
    lines = ["".join(rng.choices(parts, k=rng.randint(1, 14))) for _ in range(3000)] + ["x" * 10**6, "\U0001f600" * 10**6, ": " * 10**5, ":" * 10**6 + " a", "a " * 10**5 + "b" * 10**6 + "@"]
    docs = spark.createDataFrame(list(enumerate(lines)), "i long, line string")
    got = {r["i"]: r["m"] for r in docs.select("i", line_templates.masked(line_templates.spaced(F.col("line"))).alias("m")).collect()}
    want = {i: " ".join("<*>" if re.search(r"[0-9@]|://", w) else w for w in brute.words(x)) for i, x in enumerate(lines)}
    assert got == want
    docs = spark.createDataFrame([(i, "\n".join(lines[j] for j in range(i, 3000, 100))) for i in range(100)], "doc_id long, text string")
    rows = [tuple(r) for r in docs.collect()]
    for depth in (0, 1, 3, 5):
        got = {r["doc_id"]: (r["kept_text"], r["n_lines"], r["n_dropped"]) for r in line_templates.drop_lines(docs, depth=depth, min_docs=2).collect()}
        assert got == {d: x for (d, _), x in zip(rows, brute.drop_lines(rows, depth=depth, min_docs=2))}


def test_lines_are_dealt_without_a_lambda(corpus):
    """A lambda is interpreted for each word; run twice over every line, it was most of the query's time."""
    plan = line_templates._lines(line_templates._keyed(corpus), 3)._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" in plan and "lambda" not in plan


def test_line_dedup_keeps_columns(corpus, corpus_rows):
    got = line_templates.without_recurring_lines(corpus)
    assert got.schema.names == corpus.schema.names
    rows = rows_of(corpus_rows)
    want = Counter((d, t if not gone else kept) for (d, t), (kept, _, gone) in zip(rows, brute.drop_lines(rows)) if not gone or brute.words(kept))
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == want


def test_nothing(nothing):
    for f in (substring_dedup.remove_repeats, substring_dedup.without_repeats, ngram_join.join_components, ngram_join.one_of_each,
              line_templates.drop_lines, line_templates.without_recurring_lines):
        assert f(nothing).count() == 0
