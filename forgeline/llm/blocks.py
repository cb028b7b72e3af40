"""Documents in bounded blocks, and questions that blocks put to shards of a hashed key space.

Documents are dealt by a hash into blocks of a few MB, so that one task holds a block as arrays.  A block asks about
its distinct keys: it sorts them, cuts them at the shards' borders and sends one blob to each shard.  A shard
joins the blobs of all blocks, and answers every blob in the order of its keys.  A key that very many
documents hold is one entry of a block, however often it occurs there, so no shard grows with a hot key's rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 4 << 20
SHARD_BYTES = 16 << 20


class Dealt:
    """docs (doc_id, text, blk and, if asked for, all columns as row), the number of blocks, and the bits of a key that name its shard."""

    def __init__(self, docs: DataFrame, block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES, row: bool = False):
        rows = [F.struct("*").alias("row")] if row else []
        docs = docs.select(*rows, F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
        size = docs.agg(F.sum(F.octet_length("text")).alias("size")).first()["size"] or 0
        self.blocks = max(1, -(-size // block_bytes))
        self.bits = max(0, int(size // shard_bytes)).bit_length()
        self.docs = docs.withColumn("blk", self.block_of(F.xxhash64("doc_id", "text")))

    def block_of(self, key: Column) -> Column:
        return F.pmod(key, F.lit(self.blocks)).cast("int")


def cuts(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where the sorted keys pass from one shard to the next; one more than shards."""
    if not bits:
        return np.array([0, len(keys)])
    borders = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.concatenate(([0], np.searchsorted(keys, borders), [len(keys)]))


def planes(a: np.ndarray, size: int | None = None) -> bytes:
    """The bytes of an integer array, all first bytes, then all second ones, and so on: equal bytes compress."""
    return a.view(np.uint8).reshape(-1, a.itemsize)[:, :size].T.tobytes()


def unplanes(raw: bytes, n: int, kind: str, size: int | None = None) -> np.ndarray:
    kind = np.dtype(kind)
    out = np.zeros((n, kind.itemsize), np.uint8)
    size = size or kind.itemsize
    out[:, :size] = np.frombuffer(raw, np.uint8, n * size).reshape(size, n).T
    return out.view(kind).ravel()


BLOB = "blk int, shard int, kind int, blob binary"


def blob_table(blk: int, kind: int, parts: Iterator[tuple[int, bytes]]) -> pa.Table:
    shard, blob = [], []
    for s, b in parts:
        shard.append(s)
        blob.append(b)
    n = len(shard)
    return pa.table([pa.array([blk] * n, pa.int32()), pa.array(shard, pa.int32()), pa.array([kind] * n, pa.int32()), pa.array(blob, pa.binary())],
                    names=["blk", "shard", "kind", "blob"])


def answered(blobs: DataFrame, kind: int, answer: Callable[[list[bytes]], list[bytes]]) -> DataFrame:
    """The answers to all blobs, for their blocks; ``answer`` gets a shard's blobs and returns as many."""
    def run(table):
        got = answer([b.as_py() for b in table.column("blob")])
        return table.set_column(2, "kind", pa.array([kind] * len(got), pa.int32())).set_column(3, "blob", pa.array(got, pa.binary()))

    return blobs.groupBy("shard").applyInArrow(run, BLOB)


def replies(table: pa.Table, kind: int) -> dict[int, bytes]:
    """A block's answers of one kind, by shard."""
    return {s: b for s, k, b in zip(table.column("shard").to_pylist(), table.column("kind").to_pylist(), table.column("blob").to_pylist()) if k == kind}
