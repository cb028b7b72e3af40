"""Bounded-space online packing of tokenized documents into fixed-length sequences.

Every partition keeps a fixed number of open windows.  A document's tokens (with its closing id) go, while
they would fill a whole window, into windows of their own; the rest goes to the open window that it fits
best.  When none fits and no more may be opened, the fullest window is topped up with the head of the
document, so that it is emitted without padding, and the rest is placed again.  The windows still open at
a partition's end are merged, a bounded number of partitions at a time: their tokens are cut at full
windows, and what remains becomes sequences of power-of-two lengths, which need no padding.

Null texts count as empty (one piece: the closing id).  Null or repeated doc_ids are packed like others.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_left, insort
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEQUENCE = 2048
OPEN_WINDOWS = 32
FAN_IN = 16  # partitions whose leftovers are merged together
END_ID = 1
_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_SCHEMA = _PIECE + ", part long, ids binary"
_KIND = {"doc_id": pa.int64(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(), "doc_tokens": pa.int64(),
         "sequence_id": pa.int64(), "offset": pa.int64(), "part": pa.int64(), "ids": pa.binary()}


@lru_cache(maxsize=2)
def byte_encoder(path: str | None = None, specials: tuple = (("<|endoftext|>", 50256),)):
    """The public byte-level BPE as ranks; its special string in a text becomes its id, as in the JSON form."""
    import public_tokenizers
    import tiktoken

    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=dict(specials))


def token_ids(enc, text: str | None, end_id: int = END_ID) -> np.ndarray:
    ids = enc.encode(text or "", allowed_special="all")
    ids.append(end_id)
    return np.array(ids, dtype="<u4")


class _Windows:
    """The open windows of one partition; pieces are held until their window is emitted."""

    def __init__(self, part: int, length: int, most: int):
        self.part, self.length, self.most = part, length, most
        self.free: list[tuple[int, int]] = []  # (room, window), ascending
        self.held: dict[int, list[tuple]] = {}
        self.made = 0
        self.rows: list[tuple] = []

    def _put(self, window: int, room: int, piece: tuple) -> None:
        """piece: doc_id, start, ids, doc_tokens."""
        doc, start, ids, total = piece
        self.held[window].append((doc, start, len(ids), zlib.crc32(ids.tobytes()), total, self.part * 2 << 32 | window, self.length - room, ids))
        room -= len(ids)
        if room:
            insort(self.free, (room, window))
        else:
            self.rows += [(*p[:7], None, None) for p in self.held.pop(window)]

    def _open(self) -> int:
        self.made += 1
        self.held[self.made - 1] = []
        return self.made - 1

    def add(self, doc, ids: np.ndarray) -> None:
        total = at = len(ids)
        at = 0
        while total - at >= self.length:
            self._put(self._open(), self.length, (doc, at, ids[at:at + self.length], total))
            at += self.length
        while at < total:
            fits = bisect_left(self.free, (total - at, -1))
            if fits < len(self.free):
                room, window = self.free.pop(fits)
            elif len(self.free) < self.most:
                room, window = self.length, self._open()
            else:
                room, window = self.free.pop(0)  # the fullest
            self._put(window, room, (doc, at, ids[at:at + room], total))
            at += min(room, total - at)

    def take(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        return _batch(rows)

    def leftovers(self) -> pa.RecordBatch:
        return _batch([(*p[:7], self.part, p[7].tobytes()) for w in sorted(self.held) for p in self.held[w]])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * len(_KIND)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _KIND.values())], names=list(_KIND))


def _pack_partition(path: str | None, length: int, most: int, end_id: int):
    def run(batches):
        from pyspark import TaskContext

        enc = byte_encoder(path)
        windows = _Windows(TaskContext.get().partitionId(), length, most)
        for b in batches:
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                windows.add(doc, token_ids(enc, text.as_py(), end_id))
                if len(windows.rows) >= 4096:
                    yield windows.take()
        yield windows.take()
        yield windows.leftovers()
    return run


def _merge(length: int):
    def run(key, pdf):
        group, out = int(key[0]), []
        pdf = pdf.sort_values(["sequence_id", "offset"], kind="stable")
        left = int(pdf["length"].sum())
        window, room, size = 0, 0, 0
        for doc, start, total, raw in zip(pdf["doc_id"], pdf["start"], pdf["doc_tokens"], pdf["ids"]):
            ids, at = np.frombuffer(raw, "<u4"), 0
            while at < len(ids):
                if not room:  # the next sequence: a full one, or the largest power of two that is left
                    size = room = length if left >= length else 1 << left.bit_length() - 1
                    window += 1
                cut = ids[at:at + room]
                out.append((doc, start + at, len(cut), zlib.crc32(cut.tobytes()), total, (group * 2 + 1) << 32 | window, size - room))
                at, room, left = at + len(cut), room - len(cut), left - len(cut)
        frame = pd.DataFrame(out, columns=_PIECE.replace(" long", "").split(", "))
        return frame.astype({c: "Int64" for c in frame.columns})
    return run


def pack(docs: DataFrame, length: int = SEQUENCE, open_windows: int = OPEN_WINDOWS, fan_in: int = FAN_IN,
         path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece; each token lies in one piece.

    Only the leftovers (at most open_windows for each partition) are shuffled.
    """
    pieces = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
              .mapInArrow(_pack_partition(path, length, open_windows, end_id), _SCHEMA).checkpoint())
    names = _PIECE.replace(" long", "").split(", ")
    merged = (pieces.where("ids is not null").groupBy(F.floor(F.col("part") / fan_in).alias("merge_group"))
              .applyInPandas(_merge(length), _PIECE))
    return pieces.where("ids is null").select(names).unionByName(merged)
