"""Newest-row-per-key operators (row_number() = 1 semantics)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str, order_by: list[str], carry: list[str],
                   count_alias: str | None = None) -> DataFrame:
    """One row per ``key``: the row with the greatest ``order_by`` tuple (all descending,
    lexicographic), its ``carry`` columns, and optionally the number of rows for the key.

    Equivalent to ``row_number() over (partition by key order by o1 desc, o2 desc ...) = 1``
    plus ``count(*) over (partition by key)``, expressed as a single aggregate so the
    planner combines map-side before the shuffle: a key holding a large share of the
    rows is reduced to one row per map task instead of landing whole in one task.
    ``order_by`` must identify a row uniquely within a key and hold no NULLs.
    """
    fields = list(order_by) + [c for c in carry if c not in order_by]
    aggs = [F.max(F.struct(*[F.col(c) for c in fields])).alias("_top")]
    if count_alias:
        aggs.append(F.count(F.lit(1)).alias(count_alias))
    out = df.groupBy(key).agg(*aggs)
    cols = [F.col(key)] + [F.col("_top")[c].alias(c) for c in fields]
    if count_alias:
        cols.append(F.col(count_alias))
    return out.select(*cols)


def merge_latest(stored: DataFrame, batch: DataFrame, key: str, order_by: list[str], carry: list[str], count_alias: str) -> DataFrame:
    """The newest row per key of two tables in the layout of ``latest_per_key``, and the sum of their counts.

    Newest rows and counts of disjoint row sets merge into those of their union, so a batch's rows are reduced by themselves
    and meet the stored row of their key only; rows that were reduced before are not read again."""
    fields = list(order_by) + [c for c in carry if c not in order_by]
    both = stored.select(key, *fields, count_alias).unionByName(batch.select(key, *fields, count_alias))
    merged = both.groupBy(key).agg(F.max(F.struct(*fields)).alias("_top"), F.sum(count_alias).alias(count_alias))
    return merged.select(key, *[F.col("_top")[c].alias(c) for c in fields], count_alias)


def top_k_per_group(df: DataFrame, partition_by: list[str], order_by: list, k: int,
                    rank_alias: str = "rank") -> DataFrame:
    """Rows ranked 1..k per group by ``order_by`` (Column expressions, e.g. F.desc(..)).

    ``row_number() <= k`` over a window plans a partial WindowGroupLimit before the
    shuffle, so each map task forwards at most k rows per group.
    """
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn(rank_alias, F.row_number().over(w)).filter(F.col(rank_alias) <= k)


def count_per_key(df: DataFrame, key: str, alias: str) -> DataFrame:
    """``count(*) over (partition by key)`` on every row, as a partial aggregate joined
    back: hot keys are pre-counted map-side, and the join back is split by AQE when a
    key's rows are skewed, instead of one task buffering a whole key's window.  The counts
    are checkpointed, as AQE splits a join only where both sides are plain exchanges.
    A NULL key is a key like others."""
    counts = df.groupBy(F.col(key).alias("_counted_key")).agg(F.count(F.lit(1)).alias(alias)).checkpoint()
    return df.join(counts, df[key].eqNullSafe(counts["_counted_key"])).drop("_counted_key")
