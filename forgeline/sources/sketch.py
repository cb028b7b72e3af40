"""Key sketches: a blocked Bloom filter of a stored batch's keys, as a small table of 64-bit words beside its files.

A key's hash names a word of its batch's filter, by its leading bits, and BITS of the word's 64 places.  A filter has a
power of two of words, about PER_WORD keys to each, so a word takes 8 bytes where the keys take many times that.  A batch's keys
are turned into probes once for each filter size, and meet all filters of that size in one join: a stored batch none of
whose words holds all places of some probe has none of the keys, and its files need not be opened.  False hits only cost a scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PER_WORD = 2.0
BITS = 6
FOLDER = "_keys"  # beside a batch's files; readers of the batch pass over names with an underscore

WORDS = "batch string, size int, word long, bits long"


def size_of(n_keys: int, per_word: float = PER_WORD) -> int:
    """The power of two that is the number of a filter's words."""
    return max(0, int(-(-n_keys // per_word)) - 1).bit_length()


def _hash(keys: list[str], salt: int) -> Column:
    return F.xxhash64(*keys, F.lit(salt))


def _word(keys: list[str], size: int) -> Column:
    return F.shiftrightunsigned(_hash(keys, 1), 64 - size) if size else F.lit(0).cast("long")


def _places(keys: list[str]) -> Column:
    """BITS (or fewer, where they meet) set places of a word."""
    other, one, out = _hash(keys, 2), F.lit(1).cast("long"), None
    for i in range(BITS):
        place = F.shiftrightunsigned(other, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        bit = F.call_function("shiftleft", one, place)
        out = bit if out is None else out.bitwiseOR(bit)
    return out


def sketch(rows: DataFrame, keys: list[str], n_rows: int, batch: str, per_word: float = PER_WORD) -> DataFrame:
    """The filter of a batch's keys; words without a key are left out."""
    size = size_of(n_rows, per_word)
    return (rows.select(_word(keys, size).alias("word"), _places(keys).alias("places")).groupBy("word").agg(F.bit_or("places").alias("bits"))
            .select(F.lit(batch).alias("batch"), F.lit(size).alias("size"), "word", "bits"))


def may_hold(sketches: DataFrame, rows: DataFrame, keys: list[str]) -> list[str]:
    """The batches whose filter may hold a key of some rows."""
    sizes = [r["size"] for r in sketches.select("size").distinct().collect()]  # powers of two: at most 64
    own = rows.select(*keys).distinct()
    probes = None
    for size in sizes:
        p = own.select(F.lit(size).alias("size"), _word(keys, size).alias("word"), _places(keys).alias("places"))
        probes = p if probes is None else probes.unionByName(p)
    if probes is None:
        return []
    hit = F.col("bits").bitwiseAND(F.col("places")) == F.col("places")
    return [r["batch"] for r in sketches.join(probes.distinct(), ["size", "word"]).where(hit).select("batch").distinct().collect()]  # a row for a batch
