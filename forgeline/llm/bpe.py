"""BPE encoding and decoding by an index of pair occurrences.

The distinct words of a block of documents are laid out as one symbol sequence.  An index maps each
mergeable pair, by its rank, to all its positions in the block.  Active ranks are taken in ascending order;
all positions of a rank are merged at once, and the positions of the pairs that a merge creates join the
lists of their ranks.  A merge rule's symbols are made by earlier rules only (checked on loading), so no rank
becomes active after it has been passed.

Null texts encode and decode to nothing.  Special tokens' strings in a text become their ids, as the public
library does by default.  Rows are handled one by one, so repeated rows get equal results.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_CHARS = 16_000_000
_NONE = np.int32(-1)
_SIGMA = str.maketrans("Σ", "σ")  # lower case character by character, without the rule for a word's last letter


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    out = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + len(out) - len(plain))
    return [out[b] for b in range(256)]


class WordBpe:
    """Lower-casing byte-level BPE with word ends, from a tokenizer's JSON form."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, suffix = spec["model"], spec["model"]["end_of_word_suffix"]
        vocab = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], np.int32)
        self.last = np.array([vocab[s + suffix] for s in symbols], np.int32)
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int32)
        born = np.full(max(vocab.values()) + 1, -1)
        born[made] = np.arange(len(made))
        if not ((born[left] < np.arange(len(made))).all() and (born[right] < np.arange(len(made))).all()):
            raise ValueError("a merge rule uses a symbol that only a later rule makes")
        order = np.argsort(left << 32 | right)
        self.codes, self.ranks = (left << 32 | right)[order], order
        self.left, self.right, self.made = left.astype(np.int32), right.astype(np.int32), made
        self.strings = {i: s for s, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings |= {i: s for s, i in self.special.items()}
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.word = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.space = regex.compile(r"\s+")
        self.unassigned = regex.compile(r"\p{Cn}")
        self.bytes_of = {s: b for b, s in enumerate(symbols)}
        self.path = path

    def words(self, text: str) -> list:
        """The words of a text to be merged each by itself; special tokens as their ids."""
        if not self.split_special or "<|" not in text:
            return self._plain(text)
        out: list = []
        for part in self.split_special.split(text):
            if part in self.special:
                out.append(self.special[part])
            else:
                out += self._plain(part)
        return out

    def _plain(self, text: str) -> list[str]:
        if not text.isascii():
            if self._unknown("".join(set(text))):
                return self._by_library(text)
            text = unicodedata.normalize("NFC", text).translate(_SIGMA)
        return self.word.findall(self.space.sub(" ", text).lower())

    def _unknown(self, chars: str) -> bool:
        """Whether Python's tables or those of ``regex``, which may be newer than the library's, lack one of the characters."""
        return any(unicodedata.category(c) == "Cn" for c in chars) or bool(self.unassigned.search(chars))

    def _by_library(self, text: str) -> list[str]:
        """The same split by the library's own normaliser and splitter."""
        from tokenizers import Tokenizer

        if not hasattr(self, "library"):
            self.library = Tokenizer.from_file(self.path)
        pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes(map(self.bytes_of.__getitem__, p)).decode() for p, _ in pieces]

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols, -1 where no rule merges it."""
        code = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[at] == code, self.ranks[at], -1)

    def merge(self, words: list[str]) -> list[np.ndarray]:
        """The ids of each word."""
        raw = [w.encode() for w in words]
        size = np.array([len(w) for w in raw], np.int64)
        first = np.concatenate(([0], np.cumsum(size)))
        n = int(first[-1])
        if not n:
            return [np.zeros(0, "<u4")] * len(words)
        data = np.frombuffer(b"".join(raw), np.uint8)
        sym = self.inner[data]
        ends = first[1:][size > 0] - 1
        sym[ends] = self.last[data[ends]]
        nxt, prv = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        nxt[ends] = _NONE
        prv[first[:-1][size > 0]] = _NONE
        alive = np.ones(n, bool)
        lists: dict[int, list[np.ndarray]] = defaultdict(list)  # rank -> positions of its pair's left symbol
        active: list[int] = []

        def note(pos: np.ndarray, rank: np.ndarray) -> None:
            some = rank >= 0
            if not some.all():
                pos, rank = pos[some], rank[some]
            if not len(pos):
                return
            order = np.argsort(rank, kind="stable")
            rank, pos = rank[order], pos[order]
            cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(rank)]):
                r = int(rank[lo])
                if r not in lists:
                    heapq.heappush(active, r)
                lists[r].append(pos[lo:hi])

        pos = np.flatnonzero(nxt != _NONE).astype(np.int32)
        note(pos, self.rank(sym[pos], sym[nxt[pos]]))
        while active:
            r = heapq.heappop(active)
            held = lists.pop(r)
            pos = held[0] if len(held) == 1 else np.unique(np.concatenate(held))
            a, b = self.left[r], self.right[r]
            pos = pos[alive[pos] & (sym[pos] == a) & (nxt[pos] != _NONE)]
            pos = pos[sym[nxt[pos]] == b]
            if a == b and len(pos) > 1:  # in a run of one symbol, from its left end
                taken, keep = -1, []
                for p, q in zip(pos.tolist(), nxt[pos].tolist()):
                    if p != taken:
                        keep.append(p)
                        taken = q
                pos = np.array(keep, np.int32)
            if not len(pos):
                continue
            gone = nxt[pos]
            sym[pos] = self.made[r]
            alive[gone] = False
            after = nxt[gone]
            nxt[pos] = after
            inner = after != _NONE
            prv[after[inner]] = pos[inner]
            before = prv[pos]
            left = before[before != _NONE]
            around = np.concatenate([left, pos[inner]])
            note(around, self.rank(sym[around], sym[nxt[around]]))
        ids, bounds = sym[alive].astype("<u4"), np.concatenate(([0], np.cumsum(alive)))[first].tolist()
        return [ids[lo:hi] for lo, hi in zip(bounds[:-1], bounds[1:])]

    def encode_block(self, texts: list[str | None]) -> Iterator[tuple[bytes, bytes]]:
        """(ids as little-endian 32-bit integers, decoded text) of each text."""
        index: dict = defaultdict()
        index.default_factory = index.__len__
        docs = [np.fromiter(map(index.__getitem__, self.words(t or "")), np.int32) for t in texts]
        index.default_factory = None
        plain = [w for w in index if isinstance(w, str)]
        merged = dict(zip(plain, self.merge(plain)))
        raw, shown = [], []
        for w in index:
            ids = merged.get(w) if isinstance(w, str) else np.array([w], "<u4")
            raw.append(ids.tobytes())
            shown.append(self.decode(ids.tolist()))
        for d in docs:
            own = d.tolist()
            yield b"".join([raw[i] for i in own]), b" ".join([shown[i] for i in own])

    def decode(self, ids: list[int]) -> bytes:
        """A vocabulary without a decoder shows its tokens' strings, special ones too, joined by a space."""
        return " ".join([self.strings[i] for i in ids]).encode()


@lru_cache(maxsize=2)
def load(path: str | None = None) -> WordBpe:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    return WordBpe(path)


def encode_decode(docs: DataFrame, path: str | None = None, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit) and decoded text of every document; no shuffle."""
    kinds = {"doc_id": pa.int64(), "ids": pa.binary(), "decoded": pa.string()}

    def flush(bpe: WordBpe, ids: list, texts: list) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for doc, (raw, shown) in zip(ids, bpe.encode_block(texts)):
            rows.append((doc, raw, shown))
            held += len(raw) + len(shown)
            if held > 8_000_000:
                yield batch(rows)
                rows, held = [], 0
        if rows:
            yield batch(rows)

    def batch(rows: list) -> pa.RecordBatch:
        doc, raw, shown = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(raw, pa.binary()), pa.array(shown, pa.binary()).cast(pa.string())], names=list(kinds))

    def run(batches):
        bpe, ids, texts, held = load(path), [], [], 0
        for b in batches:
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                ids.append(doc)
                texts.append(text)
                held += len(text or "")
                if held >= block_chars:
                    yield from flush(bpe, ids, texts)
                    ids, texts, held = [], [], 0
        yield from flush(bpe, ids, texts)

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, ids binary, decoded string"))
