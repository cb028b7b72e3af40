"""Texts of over a million characters, as many words, as many lines, and as one word, beside short ones."""

import random
from collections import Counter

import brute
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from forgeline.llm import bpe, latent_knn, line_templates, ngram_join, packing, quality_rules, substring_dedup, toxicity


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(31)
    word = lambda: "".join(rng.choices(("an", "er", "on", "re", "ing", "ed", "é", "st"), k=3))
    many = [word() for _ in range(200_000)]
    near = list(many)
    for i in range(0, len(near), 5000):
        near[i] = "changed"
    passage = " ".join(many[777:830])
    lines = "\n".join(" ".join(word() for _ in range(6)) for _ in range(30_000)) + "\n" + "Page 1 of 9\n" * 3
    out = [(1, " ".join(many)), (2, "x " + passage + " y"), (3, "w" * 1_200_000), (4, " ".join(near)), (5, lines), (6, None), (7, ""), (8, passage), (9, "w" * 1_200_000)]
    assert all(len(t) > 1_000_000 for i, t in out if i in (1, 3, 4, 5, 9))
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string").repartition(3).checkpoint()


def test_substring_dedup(docs, rows):
    got = substring_dedup.remove_repeats(docs).collect()
    assert Counter(tuple(r) for r in got) == Counter((d, " ".join(w), n, gone) for d, w, n, gone in brute.remove_repeats(rows))


def test_ngram_join(docs, rows):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.join_components(docs).collect()}
    assert got == dict(zip([d for d, _ in rows], brute.join_components(rows))) and got[4][1] == 1 and got[9][1] == 3


def test_line_dedup(docs, rows):
    got = line_templates.drop_lines(docs, min_docs=2).collect()
    want = [(d, *x) for (d, _), x in zip(rows, brute.drop_lines(rows, min_docs=2))]
    assert Counter((r["doc_id"], r["kept_text"], r["n_lines"], r["n_dropped"]) for r in got) == Counter(want)
    assert max(w[2] for w in want) > 30_000


def test_quality_rules(docs, rows):
    got = quality_rules.judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()
    kept = brute.quality_kept([(t, "en") for _, t in rows], quality_rules.COMMON, quality_rules.Rules())
    assert Counter(tuple(r) for r in got) == Counter((d, *brute.base_counts(t), brute.base_failed(t), k) for (d, t), k in zip(rows, kept))


def test_scores(docs):
    sample = [(t.encode(), y) for t, y in [("good plain words here " * 5, 0), ("vile scum " * 9, 1)] * 20]
    for module in (toxicity, latent_knn):
        model = module.fit(sample, 0.5) if module is toxicity else module.fit(sample)
        got = {r["doc_id"]: r["score"] for r in module.score(docs, model).collect()}
        assert len(got) == 9 and all(0 <= s <= 1 for s in got.values()) and got[6] == got[7] and got[3] == got[9]


def test_bpe(docs, rows):
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    some = docs.where("doc_id not in (3, 9)")  # the library itself is slow at one word of this length
    got = {r["doc_id"]: (bytes(r["ids"]), r["decoded"]) for r in bpe.encode_decode(some).collect()}
    for d, t in rows:
        if d in got:
            ids = plain.encode(t or "", add_special_tokens=False).ids
            assert got[d] == (np.array(ids, "<u4").tobytes(), plain.decode(ids, skip_special_tokens=False))
    assert len(got) == 7


def test_packing(docs, rows):
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = packing.pack(docs.where("doc_id not in (3, 9)")).collect()
    assert brute.check_packing([r.asDict() for r in pieces], [r for r in rows if r[0] not in (3, 9)], lambda t: plain.encode(t, add_special_tokens=False).ids, 2048) == 0
