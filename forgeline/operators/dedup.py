"""First-wins de-duplication and insert-if-absent."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgeline.operators.topk import top_k_per_group

#: Keys that each task may hold at once; more are joined by a shuffle.
FEW_KEYS = 500_000


def first_per_key(df: DataFrame, key_cols: list[str], order_cols: list[str]) -> DataFrame:
    """The first row per key in ``order_cols`` order (file order for CSV batches).

    ``row_number() = 1`` plans a partial WindowGroupLimit before the shuffle, so a key
    repeated many times contributes one row per map task to the exchange."""
    return top_k_per_group(df, key_cols, [F.asc(c) for c in order_cols], 1, "_rn").drop("_rn")


def insert_if_absent(new_rows: DataFrame, stored_keys: DataFrame, key_cols: list[str]) -> DataFrame:
    """Rows of ``new_rows`` whose key is not stored yet.

    The stored keys are first cut to those of the batch: that join may broadcast the batch (by Spark's own size
    check), so a small batch never shuffles the keys of all history."""
    met = stored_keys.select(*key_cols).join(new_rows.select(*key_cols), key_cols, "left_semi")
    return new_rows.join(met, key_cols, "left_anti")


def held_by_task(keys: DataFrame, n: int) -> DataFrame:
    """``keys`` to be joined with others: held by partition, so that neither side is sorted, if they are neither so few that the
    planner may broadcast them nor too many for the tasks."""
    return keys.hint("shuffle_hash") if FEW_KEYS < n <= _most_held(keys) else keys


def _most_held(df: DataFrame) -> int:
    return FEW_KEYS * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def first_per_stored_key(rows: DataFrame, key_cols: list[str], order_cols: list[str]) -> DataFrame:
    """``first_per_key`` for stored rows that seldom share a key: only the keys' hashes are shuffled.

    A row whose hash comes once is the only one of its key.  The rows of the other hashes, found by a broadcast of
    these, go through the window by their keys; if very many come again (a hash takes a quarter of a key's room), all rows do."""
    key_hash = F.xxhash64(*key_cols)
    again = rows.select(key_hash.alias("_hash")).groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_hash").checkpoint()
    n = again.count()
    if n == 0:
        return rows
    if n > 4 * FEW_KEYS:
        return first_per_key(rows, key_cols, order_cols)
    hashed, few = rows.withColumn("_hash", key_hash), F.broadcast(again)
    more = first_per_key(hashed.join(few, "_hash", "left_semi"), key_cols, order_cols)
    return hashed.join(few, "_hash", "left_anti").unionByName(more).drop("_hash")


def insert_stored_if_absent(new_rows: DataFrame, stored_keys: DataFrame, key_cols: list[str],
                            keep: Callable[[DataFrame], DataFrame] = lambda df: df.checkpoint()) -> DataFrame:
    """``insert_if_absent`` for rows of different keys that are read again at little cost: keys alone meet first.

    Where none or all of the rows are stored, as in a new batch or a repeated one, the rows meet nothing; else
    the stored keys among them are kept (``keep`` stores a DataFrame and reads it back) for the rows to meet.
    Nothing is shuffled if there are no stored keys; very many rows meet the stored keys if the tasks can hold these, else
    the stored keys meet the rows, as in ``insert_if_absent``."""
    stored_keys, new_keys = stored_keys.select(*key_cols), new_rows.select(*key_cols)
    n_stored = stored_keys.count()
    if n_stored == 0:
        return new_rows
    n_new = new_keys.count()
    if n_new > FEW_KEYS and n_stored <= _most_held(new_keys):
        met = new_keys.join(held_by_task(stored_keys, n_stored), key_cols, "left_semi")
    else:
        met = stored_keys.join(held_by_task(new_keys, n_new), key_cols, "left_semi").distinct()
    n = met.count()
    if n == 0:
        return new_rows
    if n == n_new:
        return new_rows.limit(0)
    met = keep(met)
    return new_rows.join(F.broadcast(met) if n <= FEW_KEYS else met, key_cols, "left_anti")


def append_union(history: DataFrame, new_rows: DataFrame) -> DataFrame:
    """History plus newly inserted rows (append semantics)."""
    return history.unionByName(new_rows.select(*history.columns))
