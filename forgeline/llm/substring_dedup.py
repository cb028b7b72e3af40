"""Removal of passages that occur in an earlier document, by repeated-phrase automata.

A passage is a window of WINDOW consecutive words.  Each window of a document whose word sequence also starts in
a document with a smaller doc_id is a repeat; the words that repeats cover are removed.

1. Candidates: every window has an anchor, the least hash of the ANCHOR-word sequences in it.  Equal windows have
   equal anchors, so only windows whose anchor occurs in two documents can repeat.
2. Confirmation: candidate windows are compared by 96 bits over all blocks; each gets the smallest doc_id that has it.
3. Location: the maximal runs of confirmed windows that a block's documents repeat are its passages.  They are compiled
   into Aho-Corasick automata, a bounded number of words to an automaton, and all documents of the block are
   streamed through them.  An occurrence counts if a document before its own has each of the passage's windows.

Null texts have no words.  Rows with a null doc_id have no place in the order: nothing is removed from them, and they
are no earlier document for others.  Rows with equal doc_id are not earlier than each other.
The texts are shuffled once, into blocks; the questions and answers between blocks are a few bytes for a window.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgeline.llm.blocks import BLOB, BLOCK_BYTES, SHARD_BYTES, Dealt, answered, blob_table, cuts, planes, replies, unplanes
from forgeline.llm.line_templates import with_text
from forgeline.llm.textbatch import Batch, inside, ngrams, parse, strings, word_hashes

WINDOW = 13
ANCHOR = 5
PASSAGE_WORDS = 100_000  # in one automaton, but for a single longer passage
SYMBOLS = 3       # letters that spell a word


class _Block:
    """Windows of a block's documents: their anchors and which are to be looked at."""

    def __init__(self, table: pa.Table, window: int):
        self.window = window
        self.ids = table.column("doc_id").to_pylist()
        self.batch: Batch = parse(table.column("text"))
        self.hashes = word_hashes(self.batch)
        known = np.array([i is not None for i in self.ids], bool)
        self.numbers = np.array([i or 0 for i in self.ids], np.int64)
        self.at = np.flatnonzero(inside(self.batch, window))
        self.at = self.at[known[self.batch.doc[self.at]]]
        self.doc = self.numbers[self.batch.doc[self.at]]

    def anchors(self) -> np.ndarray:
        least = ngrams(self.hashes, ANCHOR)
        width, left = 1, self.window - ANCHOR + 1
        while width < left:  # the least of ever wider stretches
            step = min(width, left - width)
            least = np.minimum(least[:-step], least[step:])
            width += step
        return least[self.at]

    def anchor_keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct anchors, whether two documents of the block have it, and the number of each window's anchor."""
        keys, which = np.unique(self.anchors(), return_inverse=True)
        low, high = np.full(len(keys), np.iinfo(np.int64).max), np.full(len(keys), np.iinfo(np.int64).min)
        np.minimum.at(low, which, self.doc)
        np.maximum.at(high, which, self.doc)
        return keys, low != high, which

    def candidates(self, got: dict[int, bytes], bits: int):
        """Distinct candidate windows: 96-bit keys in order and the smallest doc_id; then all places, and the key that is at each."""
        keys, recurs, which = self.anchor_keys()
        edge = cuts(keys, bits)
        for s, raw in got.items():
            recurs[edge[s]:edge[s + 1]] |= np.unpackbits(np.frombuffer(raw, np.uint8), count=edge[s + 1] - edge[s]).astype(bool)
        some = np.flatnonzero(recurs[which])
        at, doc = self.at[some], self.doc[some]
        a = ngrams(self.hashes, self.window, seed=31)[at]
        b = (ngrams(self.hashes, self.window, seed=77)[at] >> np.uint64(32)).astype(np.uint32)
        order = np.lexsort((b, a))
        a, b, at, doc = a[order], b[order], at[order], doc[order]
        new = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))) if len(a) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        low = np.minimum.reduceat(doc, first) if len(first) else doc
        return a[first], b[first], low, at, np.cumsum(new) - 1


def _any(blobs: list[bytes]) -> list[bytes]:
    """Of each key: does another block have it?"""
    keys = [np.frombuffer(x, "<u8") for x in blobs]
    _, which, times = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    shared, at = times[which] > 1, np.cumsum([0, *map(len, keys)])
    return [np.packbits(shared[i:j]).tobytes() for i, j in zip(at[:-1], at[1:])]


def _least(blobs: list[bytes]) -> list[bytes]:
    """Of each window: the smallest doc_id of all blocks, where that is below the block's own."""
    size = [len(x) // 20 for x in blobs]
    a = np.concatenate([unplanes(x, n, "<u8") for x, n in zip(blobs, size)])
    b = np.concatenate([unplanes(x[8 * n:], n, "<u4") for x, n in zip(blobs, size)])
    low = np.concatenate([unplanes(x[12 * n:], n, "<i8") for x, n in zip(blobs, size)])
    order = np.lexsort((b, a))
    new = np.concatenate(([True], (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])))
    least = np.empty(len(a), np.int64)
    least[order] = np.minimum.reduceat(low[order], np.flatnonzero(new))[np.cumsum(new) - 1]
    at = np.cumsum([0, *size])
    out = []
    for i, j in zip(at[:-1], at[1:]):
        less = least[i:j] < low[i:j]
        out.append(np.packbits(less).tobytes() + planes(least[i:j][less].astype("<i8")))
    return out


def passages(word: np.ndarray, at: np.ndarray, least: np.ndarray, doc: np.ndarray, window: int) -> tuple[list[np.ndarray], list[int]]:
    """The distinct maximal runs of windows that an earlier document has, as word numbers, and the last of the first documents
    that have their windows.  at, least, doc: of each candidate window the place, the first document and the own one."""
    some = least < doc
    order = np.argsort(at[some])
    at, least = at[some][order], least[some][order]
    start = np.flatnonzero(np.concatenate(([True], np.diff(at) != 1))) if len(at) else np.zeros(0, np.int64)
    latest = np.maximum.reduceat(least, start).tolist() if len(at) else []
    last = np.concatenate((start[1:], [len(at)])) - 1 if len(at) else start
    found: dict[bytes, tuple[np.ndarray, int]] = {}
    for lo, hi, g in zip(at[start].tolist(), (at[last] + window).tolist(), latest):
        p = word[lo:hi]
        found[p.tobytes()] = (p, g)
    return [p for p, _ in found.values()], [g for _, g in found.values()]


def locate(word: np.ndarray, first: np.ndarray, numbers: list, phrases: list[np.ndarray], latest: list[int], most: int = PASSAGE_WORDS) -> Iterator[tuple[int, int, int]]:
    """(document, first word, word after) of each occurrence of a passage in a document after ``latest``, by automata of about ``most`` words.

    word: word numbers of all documents, from first[d] to first[d + 1]; phrases: word numbers of each passage.  A word is
    spelled with SYMBOLS letters, of another alphabet for each place, as an automaton is slow at states with many ways on.
    """
    size = np.cumsum([len(p) for p in phrases])
    cuts_at = [0, *(np.flatnonzero(np.diff(size // most)) + 1).tolist(), len(phrases)]
    for lo, hi in zip(cuts_at[:-1], cuts_at[1:]):
        used = np.unique(np.concatenate(phrases[lo:hi]))
        base = int(np.ceil((len(used) + 1) ** (1 / SYMBOLS))) + 1
        digits = np.arange(1, len(used) + 1)[:, None] // base ** np.arange(SYMBOLS) % base
        spelling = np.zeros((int(word.max()) + 1, SYMBOLS), "<u4")  # 0: a word of no passage
        spelling[used] = 0x100 + base * np.arange(SYMBOLS) + digits
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i in range(lo, hi):
            automaton.add_word(spelling[phrases[i]].tobytes().decode("utf-32-le"), i)
        automaton.make_automaton()
        for d, number in enumerate(numbers):
            if number is not None:
                text = spelling[word[first[d]:first[d + 1]]].tobytes().decode("utf-32-le")
                for end, i in automaton.iter(text):
                    if latest[i] < number:
                        after = (end + 1) // SYMBOLS
                        yield d, after - len(phrases[i]), after


def remove_repeats(docs: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES, row: bool = False) -> DataFrame:
    """doc_id, kept_text (kept words joined by a space), n_words, n_removed of every row; row: all columns of docs, if asked for."""
    dealt = Dealt(docs, block_bytes, shard_bytes, row)
    out = T.StructType([T.StructField("row", docs.schema)] if row else []).add("doc_id", "long").add("kept_text", "string").add("n_words", "long").add("n_removed", "long")
    bits, blocks = dealt.bits, dealt.docs.groupBy("blk")

    def ask_anchors(key, table):
        keys, _, _ = _Block(table, window).anchor_keys()
        edge = cuts(keys, bits)
        return blob_table(key[0].as_py(), 1, ((s, keys[i:j].astype("<u8").tobytes()) for s, (i, j) in enumerate(zip(edge[:-1], edge[1:])) if j > i))

    first = answered(blocks.applyInArrow(ask_anchors, BLOB), 1, _any)

    def ask_windows(key, table, got):
        if not table.num_rows:
            return blob_table(0, 2, iter(()))
        a, b, low, _, _ = _Block(table, window).candidates(replies(got, 1), bits)
        edge = cuts(a, bits)
        return blob_table(key[0].as_py(), 2, ((s, planes(a[i:j].astype("<u8")) + planes(b[i:j].astype("<u4")) + planes(low[i:j].astype("<i8")))
                                              for s, (i, j) in enumerate(zip(edge[:-1], edge[1:])) if j > i))

    second = answered(blocks.cogroup(first.groupBy("blk")).applyInArrow(ask_windows, BLOB), 2, _least)

    def remove(key, table, got):
        block = _Block(table, window)
        a, _, low, at, key_at = block.candidates(replies(got, 1), bits)
        edge = cuts(a, bits)
        for s, raw in replies(got, 2).items():
            i, j = edge[s], edge[s + 1]
            less = np.unpackbits(np.frombuffer(raw, np.uint8), count=j - i).astype(bool)
            low[i:j][less] = unplanes(raw[-(-(j - i) // 8):], int(less.sum()), "<i8")
        _, word = np.unique(block.hashes, return_inverse=True)
        first = block.batch.first
        covered = np.zeros(len(block.hashes) + 1, np.int64)
        phrases, latest = passages(word, at, low[key_at], block.numbers[block.batch.doc[at]], window)
        if phrases:
            hits = np.array([(first[d] + i, first[d] + j) for d, i, j in locate(word, first, block.ids, phrases, latest)], np.int64)
            np.add.at(covered, hits[:, 0], 1)
            np.add.at(covered, hits[:, 1], -1)
        keep = np.cumsum(covered)[:-1] == 0
        kept = np.bincount(block.batch.doc[keep], minlength=len(block.batch))
        n = block.batch.n_words
        return pa.table([*([table.column("row")] if row else []), table.column("doc_id"), pa.array(strings(block.batch, keep), pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(n - kept, pa.int64())],
                        names=out.names)

    both = first.unionByName(second)
    return blocks.cogroup(both.groupBy("blk")).applyInArrow(remove, out)


def without_repeats(docs: DataFrame) -> DataFrame:
    """docs with the kept words as text (and its length in n_chars, where there is one); rows that had words and have none left go."""
    kept = remove_repeats(docs, row=True).where("n_removed = 0 or n_removed < n_words")
    return with_text(kept, docs, F.when(F.col("n_removed") == 0, F.col("row.text")).otherwise(F.col("kept_text")))
