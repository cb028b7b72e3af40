"""Rule-based quality verdicts: repetition and length rules, and divergence from language references.

Every document gets two histograms: character classes, and common words of each reference language.  The
references are the summed histograms of all documents of a language that pass the base rules, so they
follow the corpus.  A document is rejected when, for every language, its Jensen-Shannon distance to the
reference is above the threshold in either histogram.  A histogram is only judged on documents long enough
for it (minimum-length guards); shorter ones pass that test.

Reference languages are those of COMMON and every other value of lang that min_docs documents or more have (the
max_languages most frequent of them); their common words are learnt, the most frequent ones of their documents that pass
the base rules.  A document of a rarer language, for which there is no reference, is judged by the base rules
alone; one without a language by the nearest reference.

Null and empty texts have no words and fail the base rules.  Equal rows get equal verdicts.  Only the
learnt words and the reference counts (languages x bins) reach the driver.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forgeline.llm.textbatch import _LOWER, Batch, inside, mix64, ngrams, parse, word_hashes

#: Function words of each reference language.
COMMON = {
    "en": "the of and to in a is that for it was on are with as by at from this be or an have not",
    "fr": "de la le et les des en un du une que est pour qui dans sur pas au par plus avec ce ne se",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an er",
    "es": "de la que el en y a los del se las por un para con no una su al es lo como más o",
}
SYMBOLS = b"#*$%&|<>"
_CLASSES = 11


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    max_repeat_pct: int = 50
    chars_distance: float = 0.20   # to the nearest language, of character classes
    words_distance: float = 0.28   # and of common words
    min_chars: int = 200           # guards: characters and words that a histogram needs to be judged
    min_hist_words: int = 100
    min_docs: int = 20             # of a language outside COMMON, to be a reference
    max_languages: int = 500       # of those
    common_words: int = 30         # learnt for each


def _class_table() -> np.ndarray:
    t = np.full(256, 6, dtype=np.int64)                # other ASCII
    t[97:123], t[65:91], t[48:58] = 0, 1, 2
    t[[32, 9, 10, 11, 12, 13]] = 3
    t[list(b".,")] = 4
    t[list(b";:!?'\"()-")] = 5
    t[0xC0:0xE0], t[0xE0:0xF0], t[0xF0:] = 7, 8, 9     # lead bytes of longer code points
    t[0x80:0xC0] = 10                                  # their other bytes; dropped
    return t


_CLASS = _class_table()


class Words:
    """The common words of each reference language, by hash."""

    def __init__(self, common: dict[str, str]):
        words = sorted({w for ws in common.values() for w in ws.split(" ")})
        h = word_hashes(parse(pa.array([" ".join(words)])))
        order = np.argsort(h)
        self.table, names = h[order], np.array(words, dtype=object)[order]
        self.own = {lang: np.flatnonzero(np.isin(names, ws.split(" "))) for lang, ws in common.items()}

    def count(self, b: Batch) -> np.ndarray:
        """How often each text has each common word."""
        n, size = len(b), len(self.table)
        h = word_hashes(replace(b, data=_LOWER[b.data]))
        at = np.minimum(np.searchsorted(self.table, h), size - 1)
        known = self.table[at] == h
        return np.bincount(b.doc[known] * size + at[known], minlength=n * size).reshape(n, size)


def histograms(b: Batch, words: Words) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Character classes of each text; for each language its common words' counts and, last, all others'."""
    n = len(b)
    size = np.diff(b.offsets)
    doc = np.repeat(np.arange(n), size)
    chars = np.bincount(doc * _CLASSES + _CLASS[b.data], minlength=n * _CLASSES).reshape(n, _CLASSES)[:, :10]
    seen = words.count(b)
    return chars, {lang: np.column_stack([seen[:, own], b.n_words - seen[:, own].sum(axis=1)]) for lang, own in words.own.items()}


def distance(rows: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2) of each row of counts to the reference counts."""
    p = rows / np.maximum(rows.sum(axis=1, keepdims=True), 1)
    q = (reference / max(reference.sum(), 1))[None, :]
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        kl = np.where(p > 0, p * np.log2(p / m), 0).sum(axis=1) + np.where(q > 0, q * np.log2(q / m), 0).sum(axis=1)
    return np.sqrt(np.maximum(kl / 2, 0))


def base_counts(b: Batch) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text."""
    n = len(b)
    lead = (b.data & 0xC0) != 0x80
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    space = np.zeros(256, bool)
    space[[9, 10, 11, 12, 13, 32]] = True
    dup = np.zeros(n, np.int64)
    for i in range(n):
        lines = Counter(x for x in b.text(i).split(b"\n") if x.strip())
        dup[i] = sum(lines.values()) - len(lines)
    repeat = np.zeros(n, np.int64)
    h = ngrams(word_hashes(b), 3)
    if len(h):
        ok = np.flatnonzero(inside(b, 3))
        key = mix64(h[ok] ^ mix64(b.doc[ok].astype(np.uint64)))
        _, which, times = np.unique(key, return_inverse=True, return_counts=True)
        at = ok[times[which] > 1]
        covered = np.zeros(len(b.starts), bool)
        for j in range(3):
            covered[at + j] = True
        repeat = np.bincount(b.doc[covered], minlength=n)
    return {"n_words": b.n_words, "word_chars": b.per_doc(lead & ~space[b.data]), "n_symbols": b.per_doc(symbol[b.data]),
            "n_dup_lines": dup, "n_repeat_words": repeat}


def base_failed(c: dict[str, np.ndarray], rules: Rules) -> np.ndarray:
    return (c["n_words"] < rules.min_words) | (100 * c["n_repeat_words"] > rules.max_repeat_pct * c["n_words"])


def _text_and_lang(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))


def _word_counts(rules: Rules):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b = parse(batch.column("text"))
            good = ~base_failed(base_counts(b), rules)
            seen: Counter = Counter()
            for i, lang in enumerate(batch.column("lang").to_pylist()):
                if good[i]:
                    seen.update((lang, w) for w in _LOWER[np.frombuffer(b.text(i), np.uint8)].tobytes().split())
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in seen], pa.string()), pa.array([k[1] for k in seen], pa.binary()),
                                              pa.array(list(seen.values()), pa.int64())], names=["lang", "word", "n"])
    return run


def common_words(docs: DataFrame, rules: Rules = Rules()) -> dict[str, str]:
    """The common words of every reference language: COMMON, and those learnt for other languages of the corpus."""
    docs = _text_and_lang(docs)
    others = [r["lang"] for r in docs.where(F.col("lang").isNotNull() & ~F.col("lang").isin(*COMMON)).groupBy("lang").agg(F.count("*").alias("n"))
              .where(F.col("n") >= rules.min_docs).orderBy(F.desc("n"), "lang").limit(rules.max_languages).collect()]
    if not others:
        return COMMON
    counts = (docs.where(F.col("lang").isin(*others)).mapInArrow(_word_counts(rules), "lang string, word binary, n long")
              .groupBy("lang", "word").agg(F.sum("n").alias("n")))
    most = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    learnt: dict[str, list[str]] = {}
    for r in counts.withColumn("at", F.row_number().over(most)).where(F.col("at") <= rules.common_words).collect():
        learnt.setdefault(r["lang"], []).append(bytes(r["word"]).decode())
    return COMMON | {lang: " ".join(sorted(ws)) for lang, ws in learnt.items()}


def _sums(words: Words, rules: Rules):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            b = parse(batch.column("text"))
            chars, common = histograms(b, words)
            good = ~base_failed(base_counts(b), rules)
            lang = np.array(batch.column("lang").to_pylist(), dtype=object)
            for name in common:
                if (own := good & (lang == name)).any():
                    total[name] = total.get(name, 0) + np.concatenate([chars[own].sum(axis=0), common[name][own].sum(axis=0)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.string()), pa.array([v.tolist() for v in total.values()], pa.list_(pa.int64()))], names=["lang", "counts"])
    return run


class References:
    """Summed character-class and common-word counts of each reference language over all documents that pass the base rules."""

    def __init__(self, docs: DataFrame, rules: Rules = Rules()):
        self.rules, self.words = rules, Words(common_words(docs, rules))
        parts = _text_and_lang(docs).mapInArrow(_sums(self.words, rules), "lang string, counts array<long>")
        rows = (parts.select("lang", F.posexplode("counts").alias("bin", "n")).groupBy("lang", "bin").agg(F.sum("n").alias("n"))
                .orderBy("lang", "bin").collect())  # languages x bins
        counts: dict[str, list[int]] = {}
        for r in rows:
            counts.setdefault(r["lang"], []).append(r["n"])
        self.counts = {k: np.array(v, dtype=float) for k, v in counts.items()}

    def judge(self, b: Batch, langs: list) -> dict[str, np.ndarray]:
        """Base counts, distances in characters and words to the nearest language, and the verdict on each text."""
        rules, c, n = self.rules, base_counts(b), len(b)
        chars, common = histograms(b, self.words)
        few_chars, few_words = chars.sum(axis=1) < rules.min_chars, b.n_words < rules.min_hist_words
        best_c, best_w, fine = np.ones(n), np.ones(n), np.zeros(n, bool)
        for lang, ref in self.counts.items():
            d, w = distance(chars, ref[:10]), distance(common[lang], ref[10:])
            best_c, best_w = np.minimum(best_c, d), np.minimum(best_w, w)
            fine |= (few_chars | (d <= rules.chars_distance)) & (few_words | (w <= rules.words_distance))
        fine |= np.array([not self.counts or (x is not None and x not in self.counts) for x in langs], bool)
        failed = base_failed(c, rules)
        return c | {"base_failed": failed, "kept": ~failed & fine, "chars_distance": best_c, "words_distance": best_w}


_OUT = {"doc_id": pa.int64(), "n_words": pa.int64(), "word_chars": pa.int64(), "n_symbols": pa.int64(), "n_dup_lines": pa.int64(),
        "n_repeat_words": pa.int64(), "base_failed": pa.bool_(), "kept": pa.bool_(), "chars_distance": pa.float64(), "words_distance": pa.float64()}
_DDL = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean,"
        " kept boolean, chars_distance double, words_distance double")


def judge(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row of counts, distances and verdict per document; one pass for the references and one for the verdicts."""
    refs = References(docs, rules)

    def run(batches):
        for batch in batches:
            v = refs.judge(parse(batch.column("text")), batch.column("lang").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(v[k], _OUT[k]) for k in list(_OUT)[1:])], names=list(_OUT))

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
            .mapInArrow(run, _DDL))


def keep_good(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    refs = References(docs, rules)

    def run(batches):
        for batch in batches:
            column = lambda name: batch.column(batch.schema.get_field_index(name))
            yield batch.filter(pa.array(refs.judge(parse(column("text")), column("lang").to_pylist())["kept"]))

    return docs.mapInArrow(run, docs.schema)
