"""LM scoring, classifiers, quality rules and vector search."""

import math
import random
import tracemalloc
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpus_fixture import corpus, corpus_rows, nothing  # noqa: F401

from forgeline.llm import latent_knn, lm_scoring, quality_rules, toxicity, vafile
from forgeline.llm.labelled import fit_sample
from forgeline.llm.textbatch import parse


def brute_lm(rows, target):
    count = Counter(w for _, t in rows for w in brute.words(t))
    mapped = [[w if count[w] >= lm_scoring.MIN_COUNT else None for w in brute.words(t)] for _, t in rows]
    vocabulary = sum(c >= lm_scoring.MIN_COUNT for c in count.values())

    def model(which):
        one, two = Counter(), Counter()
        for i in which:
            one.update(mapped[i])
            two.update(zip(mapped[i], mapped[i][1:]))
        return one, two, sum(one.values())

    is_target = [d is not None and d in target for d, _ in rows]
    models = [model([i for i, x in enumerate(is_target) if x]), model(range(len(rows)))]
    out = []
    for i, w in enumerate(mapped):
        own_one, own_two, bits = Counter(w), Counter(zip(w, w[1:])), []
        for (one, two, n), mine in zip(models, (is_target[i], True)):
            total = 0.0
            for k, x in enumerate(w):
                p = (one[x] - own_one[x] * mine + lm_scoring.ADD) / (n - len(w) * mine + lm_scoring.ADD * (vocabulary + 1))
                if k:
                    h = w[k - 1]
                    p = (two[h, x] - own_two[h, x] * mine + lm_scoring.PULL * p) / (one[h] - own_one[h] * mine + lm_scoring.PULL)
                total -= math.log2(p)
            bits.append(total / max(1, len(w)))
        out.append((rows[i][0], len(w), *(round(b, 6) for b in bits)))
    return out


@pytest.mark.parametrize("block_bytes,shard_bytes", [(1 << 23, 1 << 24), (4000, 9000)])
def test_lm_scoring(spark, corpus, corpus_rows, block_bytes, shard_bytes):
    target = [i * 3 + 1 for i in range(0, 70, 2)] + [912, 913]
    ids = spark.createDataFrame([(x, "z") for x in [*target, None, target[0]]], "doc_id long, text string")
    got = lm_scoring.cross_entropy_difference(corpus, ids, block_bytes, shard_bytes).collect()
    have = sorted(((r["doc_id"], r["n_words"], round(r["target_bits"], 6), round(r["background_bits"], 6)) for r in got), key=lambda x: (x[0] is None, x[0] or 0, x[1:]))
    want = sorted(brute_lm([(r[0], r[1]) for r in corpus_rows], set(target)), key=lambda x: (x[0] is None, x[0] or 0, x[1:]))
    assert [h[:2] for h in have] == [w[:2] for w in want]
    assert np.allclose([h[2:] for h in have], [w[2:] for w in want], atol=3e-6)


def _lm_block(n_docs):
    """A block of many short documents with answers from shards that hold nothing else, as cross_entropy_difference makes them."""
    rng = random.Random(7)
    table = pa.table({"doc_id": pa.array(range(n_docs), pa.int64()), "text": [" ".join(f"w{int(rng.random() ** 3 * 20_000)}" for _ in range(60)) for _ in range(n_docs)]})
    kinds = lambda kind, parts: [(s, kind, lm_scoring._sums([b])[0], None) for s, b in parts]
    rows = [(0, 0, None, d) for d in range(0, n_docs, 3)]
    got = lambda: pa.table([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.binary(), pa.int64()))], names=["shard", "kind", "blob", "doc_id"])
    t = lm_scoring._Texts(table, got())
    rows += kinds(1, lm_scoring._blob(t.keys, *t.counts(t.which, len(t.keys), t.own), 2))
    t.with_words(got(), 2)
    rows += kinds(2, lm_scoring._blob(t.pairs, *t.counts(t.pair, len(t.pairs), t.own[t.second]), 2))
    return table, got()


def _lm_scores(table, got):
    t = lm_scoring._Texts(table, got)
    t.with_words(got, 2)
    return t.scores(got, 2)


def test_lm_scores_do_not_depend_on_the_words_scored_at_a_time(monkeypatch):
    table, got = _lm_block(50)
    whole = _lm_scores(table, got)
    for words in (1, 61, 1000):
        monkeypatch.setattr(lm_scoring, "SCORED_WORDS", words)
        assert all((a == b).all() for a, b in zip(whole, _lm_scores(table, got)))


def test_lm_scoring_holds_few_arrays_of_a_block():
    table, got = _lm_block(8000)  # 480,000 words
    tracemalloc.start()
    _lm_scores(table, got)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 480_000 * 130, peak / 480_000  # bytes for each word


def labelled_texts(n=900, seed=1):
    rng = random.Random(seed)
    syllables = "an er on in the re ing ed tion ou ha es st or ti he".split()
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(1, 3)))
    out = []
    for i in range(n):
        w = [word() for _ in range(rng.randint(30, 300))]
        toxic, junk = i % 5 == 0, i % 7 == 0
        if toxic:
            for _ in range(3 + len(w) // 25):
                w.insert(rng.randrange(len(w)), rng.choice(["blockhead", "dimwitted", "vermin", "rottenzz", "scoundrel"]))
        if junk:
            w = [x.upper() + "!!" for x in w] if i % 2 else [x for x in w[:10] for _ in range(12)]
        out.append((i, " ".join(w), int(toxic), int(not junk)))
    return out


def accuracy(scores, truth):
    return np.mean([(s >= 0.3) == bool(truth[d]) for d, s in scores.items()])


def test_toxicity_held_out(spark):
    rows = labelled_texts()
    docs = spark.createDataFrame([(d, t) for d, t, _, _ in rows] + [(5000, None), (5001, ""), (5002, "x" * 70000), (None, "a b")], "doc_id long, text string")
    labels = spark.createDataFrame([(d, x, q) for d, _, x, q in rows] + [(None, 1, 1), (3, None, 1)], "doc_id long, toxic int, quality int")
    learn = F.col("doc_id") % 3 != 0
    sample = fit_sample(docs, labels, "toxic", learn)
    again = fit_sample(docs, labels, "toxic", learn)
    assert sample == again and all(y in (0, 1) for _, y in sample[0])
    got = toxicity.score(docs, toxicity.fit(*sample)).collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got) and len(got) == len(rows) + 4
    held = {r["doc_id"]: r["score"] for r in got if r["doc_id"] is not None and r["doc_id"] < 5000 and r["doc_id"] % 3 == 0}
    assert accuracy(held, {d: x for d, _, x, _ in rows}) > 0.93


def test_toxicity_has_a_dictionary_of_toxic_text():
    """Its runs come from all over the toxic texts, those of the ordinary ones from all over the ordinary texts."""
    sample = [(t.encode(), x) for _, t, x, _ in labelled_texts(150)]
    (ordinary, toxic), = toxicity.fit(sample, 0.2).dictionaries[1]
    learn = [s for i, s in enumerate(sample) if i % 3]
    for dictionary, label in ((ordinary, 0), (toxic, 1)):
        own = [t.lower().split() for t, y in learn if y == label]
        late = [b" ".join(w[i:i + 12]) in dictionary for w in own for i in range(24, len(w) - 12, 12)]
        assert sum(late) > 100 and any(late[-30:])


def test_toxicity_windows_compressed_one_by_one():
    """The features are those of window lengths that plain compressors give, one call for a window."""
    rng = random.Random(6)
    text = lambda bad: " ".join(rng.choice(("vile scum rotten".split() if bad and rng.random() < 0.2 else "sun rain cloud river stone tree".split())) for _ in range(60)).encode()
    model = toxicity.fit([(text(i % 4 == 0), int(i % 4 == 0)) for i in range(240)], 0.25)
    texts = [b"", b"one", text(True), text(False), b"word " * 30_000 + b"vile scum " + b"\xc3\xa9" * 400_000, "a\u2003b ".encode() * 50]
    got = toxicity.differences(model.compressors(), texts, most=1000)
    alone = [[[toxicity._compressor(d) for d in pair] for pair in group] for group in model.dictionaries]
    for t, row in zip(texts, got):
        ws = toxicity.windows(toxicity.words(t))
        for g, group in enumerate(alone):
            gains = [np.mean([len(o.compress(w)) - len(x.compress(w)) for o, x in group]) for w in ws]
            both = sorted((a + b for a, b in zip(gains, gains[1:])), reverse=True)
            over = sum(max(x - 4, 0) for x in both)
            want = [max(x, 0) for x in (both + [0, 0, 0])[:3]] + [math.log1p(over), over / max(1, len(both))]
            assert row[5 * g:5 * g + 5].tolist() == pytest.approx(want)


def test_toxicity_without_classes(spark, nothing):
    model = toxicity.fit([(b"a b c", 0)] * 5, 0.25)
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    assert [r["score"] for r in toxicity.score(docs, model).collect()] == [0.25, 0.25]
    assert toxicity.score(nothing, toxicity.fit([], 0.0)).count() == 0


def test_quality_held_out(spark):
    rows = labelled_texts()
    docs = spark.createDataFrame([(d, t) for d, t, _, _ in rows] + [(5000, None), (5001, ""), (5002, "y" * 70000), (None, "a b")], "doc_id long, text string")
    labels = spark.createDataFrame([(d, q) for d, _, _, q in rows], "doc_id long, quality int")
    sample, _ = fit_sample(docs, labels, "quality", F.col("doc_id") % 3 != 0, rows=300)
    got = latent_knn.score(docs, latent_knn.fit(sample)).collect()
    assert all(0 <= r["score"] <= 1 for r in got) and len(got) == len(rows) + 4
    held = {r["doc_id"]: r["score"] for r in got if r["doc_id"] is not None and r["doc_id"] < 5000 and r["doc_id"] % 3 == 0}
    assert accuracy(held, {d: q for d, _, _, q in rows}) > 0.95


def test_votes_are_exact_cosine():
    rows = labelled_texts(120)
    m = latent_knn.fit([(t.encode(), q) for _, t, _, q in rows], rank=8)
    b = parse(pa.array([t for _, t, _, _ in rows[:20]]))
    v = latent_knn._unit(latent_knn._tfidf(latent_knn.counts(b), m.weight) @ m.axes)
    for got, x in zip(latent_knn.votes(b, m, k=7), v):
        cos = m.vectors @ x
        near = np.argsort(-cos, kind="stable")[:7]
        w = np.maximum(cos[near], 1e-6).astype(float) ** 8
        assert abs(got - (w * m.labels[near]).sum() / w.sum()) < 1e-5
    assert latent_knn.votes(b, latent_knn.fit([]))[0] == 0.5


def test_quality_rules(corpus, corpus_rows):
    rules = quality_rules.Rules(chars_distance=0.12, words_distance=0.3)
    got = quality_rules.judge(corpus, rules).collect()
    kept = brute.quality_kept([(r[1], r[2]) for r in corpus_rows], quality_rules.COMMON, rules)
    want = Counter((r[0], *brute.base_counts(r[1]), brute.base_failed(r[1]), k) for r, k in zip(corpus_rows, kept))
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert Counter(tuple(r[c] for c in names) for r in got) == want
    assert 0 < sum(kept) < sum(not brute.base_failed(r[1]) for r in corpus_rows)
    good = quality_rules.keep_good(corpus, rules)
    assert good.schema.names == corpus.schema.names
    assert Counter(r["doc_id"] for r in good.select("doc_id").collect()) == Counter(r[0] for r, k in zip(corpus_rows, kept) if k)


def italian(n=60, lang="it"):
    """Plain prose in another language, and junk beside it: repeated capitals, symbols, and words in no proportion."""
    rng = random.Random(11)
    common = "di che e la il un a per è una in sono mi non si ho lo ma ti ha le con i cosa da se come io ci questo".split()
    parts = "ca sa mo lo re ti no ra te ve do ni pa vo ci gra zia fi".split()
    word = lambda: rng.choice(common) if rng.random() < 0.4 else "".join(rng.choices(parts, k=rng.randint(2, 4)))
    good = [(i, " ".join(word() for _ in range(300)) + ".", lang) for i in range(n)]
    junk = [(1000, " ".join("".join(rng.choices("#$%&|<>@XYZ", k=6)) for _ in range(300)), lang), (1001, " ".join("".join(rng.choices("BCDFGHJKLMNPQRSTVWXZ", k=8)) for _ in range(300)), lang),
            (1002, " ".join(str(rng.randrange(10 ** 6)) for _ in range(300)), lang), (1003, " ".join("".join(rng.choices(parts, k=5)) for _ in range(300)), lang)]
    return good, junk


def test_no_language_is_dropped(spark):
    """A language that no list names is judged against its own documents: prose stays, junk goes."""
    rng = random.Random(3)
    word = lambda: rng.choice(quality_rules.COMMON["en"].split()) if rng.random() < 0.4 else "".join(rng.choices("an er on re ing ed ou ha es st or".split(), k=3))
    english = [(5000 + i, " ".join(word() for _ in range(300)), "en") for i in range(60)]
    good, junk = italian()
    rare, _ = italian(5, "rm")
    rows = english + good + junk + [(2000 + i, t, g) for i, t, g in rare] + [(3000, good[0][1], None), (3001, junk[0][1], None)]
    rules = quality_rules.Rules()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.judge(docs, rules).collect()}
    assert all(kept[i] for i, _, _ in english + good) and not any(kept[i] for i, _, _ in junk)
    assert all(kept[2000 + i] for i in range(5))  # five documents are no reference: the base rules alone
    assert kept[3000] and not kept[3001]
    assert [kept[i] for i, _, _ in rows] == brute.quality_kept([(t, g) for _, t, g in rows], quality_rules.COMMON, rules)
    assert {r["doc_id"] for r in quality_rules.keep_good(docs, rules).collect()} == {i for i, k in kept.items() if k}


def test_nearest_takes_the_first_of_equal_rows():
    rng = np.random.default_rng(2)
    cos = rng.integers(0, 6, size=(300, 90)).astype(np.float32) / 8
    cos[0] = 0.5
    want = [sorted(sorted(range(90), key=lambda j: (-row[j], j))[:25]) for row in cos]
    assert latent_knn._nearest(cos, 25).tolist() == want and want[0] == list(range(25))
    assert latent_knn._nearest(cos, 90).tolist() == [list(range(90))] * 300


def test_fit_sample_is_filled_up(spark):
    """Long texts are no part of a fit, but do not make it smaller; contradictory labels are left out."""
    docs = spark.createDataFrame([(i, "long " * 20_000 if i % 10 else f"text {i}") for i in range(400)] + [(0, "text 00")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i // 10 % 2) for i in range(400)] + [(20, 1), (30, 1)], "doc_id long, quality int")
    sample, share = fit_sample(docs, labels, "quality", F.lit(True), rows=15)
    assert sorted(y for _, y in sample) == [0] * 15 + [1] * 15 and b"text 20" not in dict(sample) and share == 200 / 399
    everything, _ = fit_sample(docs, labels, "quality", F.lit(True), rows=100)
    assert len(everything) == 39 and b"text 0" in dict(everything) and b"text 00" not in dict(everything)


def test_quality_rules_nothing(nothing):
    assert quality_rules.judge(nothing).count() == 0 and quality_rules.keep_good(nothing).count() == 0


@pytest.mark.parametrize("block,query_block,cells", [(4096, 512, 256), (16, 3, 256), (40, 2, 4), (16, 3, 1)])
def test_top_k(spark, block, query_block, cells):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=6).round(1)]) for i in range(130)]
    rows += [(50, rows[3][1]), (300, rows[7][1]), (301, rows[7][1]), (302, [0.0] * 6), (400, None), (401, []), (402, [1.0, None, 0, 0, 0, 0]),
             (403, [float("nan")] + [0.0] * 5), (404, [float("inf")] + [0.0] * 5), (None, rows[0][1]), (450, [1.0, 2.0])]
    single = [(i, v and [x if x is None else float(np.float32(x)) for x in v]) for i, v in rows if (i, v) != (50, rows[3][1])]
    vectors = spark.createDataFrame([(i, v, 1, 2.0) for i, v in single], "vec_id long, embedding array<float>, rank int, score double")
    got = vafile.top_k(vectors, vectors.where("vec_id % 50 = 0"), block=block, query_block=query_block, cells=cells).collect()
    want = brute.best_products(single)
    assert {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got} == want and len(got) == len(want)
    # a second vector of one id is a candidate of its own; a repeated query row is asked once
    double = vectors.union(vectors.where("vec_id in (50, 60)"))
    got = vafile.top_k(double, double.where("vec_id = 50"), block=block, query_block=query_block, cells=cells).collect()
    assert [r["rank"] for r in sorted(got)] == [1, 2, 3, 4, 5] and all(r["vec_id"] != 50 for r in got)


def test_top_k_few(spark):
    v = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [-1.0, 0.5])], "vec_id long, embedding array<float>")
    got = [(r["query_id"], r["rank"], r["vec_id"]) for r in vafile.top_k(v, v.where("vec_id = 0")).collect()]
    assert got == [(0, 1, 1), (0, 2, 2)]
    assert vafile.top_k(v.where("false"), v.where("false")).count() == 0


@pytest.mark.parametrize("scale,cells,most", [(256, 256, 0.02), (1 << 16, 256, 0.02), (1 << 16, 16, 0.5)])
def test_top_k_reads_few_exact_vectors(spark, scale, cells, most):
    """The scan leaves few of all pairs, the best k among them, and bounds hold every exact score; copies do not add to it."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(1500, 24)) / 5
    x[700:1300] = x[10]  # two fifths of all rows are one vector
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    q, v = vafile.prepared(rows, rows.where("vec_id % 50 = 0"), 5, scale)
    assert v.count() == 900 + 5 and q.count() == 30  # ids 10 and 700 to 704 of the copies
    left = vafile.scan(q, vafile.approximations(v, cells), 5, block=200, query_block=7).checkpoint()
    assert 150 <= left.count() <= max(150, most * 30 * 905)
    whole = np.floor(scale * x).astype(np.int64)
    for r in vafile.read(left, q, v).join(left, ["q", "query_id", "place", "vec_id"]).collect():
        assert r["lower"] <= r["score"] <= r["upper"] and r["score"] == whole[r["query_id"]] @ whole[r["vec_id"]]
    want = set()
    for i in range(0, 1500, 50):
        best = sorted((-int(s), j) for j, s in enumerate(whole @ whole[i]) if j != i)[:5]
        want |= {(i, n, j, -s) for n, (s, j) in enumerate(best, 1)}
    assert {tuple(r) for r in vafile.top_k(rows, rows.where("vec_id % 50 = 0"), scale=scale, cells=cells).collect()} == want


def test_top_k_large_components(spark):
    """Whole numbers that doubles might round raise an error; large ones below are exact."""
    big = spark.createDataFrame([(0, [2.0 ** 17, 1.0]), (1, [2.0 ** 17, 2.0]), (2, [2.0 ** 17, 3.0])], "vec_id long, embedding array<double>")
    got = vafile.top_k(big, big.where("vec_id = 0"), k=1).collect()
    assert [(r["vec_id"], r["score"]) for r in got] == [(2, (1 << 50) + 256 * 768)]
    over = big.withColumn("embedding", F.transform("embedding", lambda c: c * 16))
    with pytest.raises(Exception, match="too large"):
        vafile.top_k(over, over, k=1).collect()
