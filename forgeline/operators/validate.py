"""Row validation: ordered rules, foreign-key marking, routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgeline.operators.dedup import FEW_KEYS, held_by_task


def first_failure(rules: list[tuple[Column, str]]) -> Column:
    """Reason of the first rule whose predicate holds, else NULL.

    Predicates are NULL-safe by construction (a NULL predicate counts as passing)."""
    expr = None
    for pred, reason in rules:
        cond = F.coalesce(pred, F.lit(False))
        expr = F.when(cond, F.lit(reason)) if expr is None else expr.when(cond, F.lit(reason))
    return expr


def mark_known(df: DataFrame, fk_col: str, parent_keys: DataFrame, parent_col: str,
               flag: str, parent_unique: bool = True, n_keys: int | None = None) -> DataFrame:
    """Add boolean ``flag``: does ``fk_col`` occur among ``parent_keys[parent_col]``?

    A left join against the key column keeps accepted and rejected rows in one pass; the planner broadcasts
    the keys by its size check, or AQE splits the skewed partitions of ``df``.  ``n_keys``: their number, where it is known: few are
    broadcast, and more are held by partition, so that the rows of ``df`` are neither sorted nor spilled.
    Stored parent keys are unique (primary key), so no de-duplication shuffle is needed;
    pass ``parent_unique=False`` for an arbitrary key set.
    """
    keys = parent_keys.select(F.col(parent_col).alias("_parent_key"))
    if not parent_unique:
        keys = keys.dropDuplicates(["_parent_key"])
    keys = keys.withColumn("_parent_hit", F.lit(True))
    if n_keys is not None and n_keys <= FEW_KEYS:
        keys = F.broadcast(keys)
    elif n_keys is not None and n_keys <= FEW_KEYS * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        keys = keys.hint("shuffle_hash")
    joined = df.join(keys, df[fk_col] == keys["_parent_key"], "left")
    return joined.withColumn(flag, F.coalesce(F.col("_parent_hit"), F.lit(False))).drop(
        "_parent_key", "_parent_hit")


def named_keys(df: DataFrame, fk_col: str, parent_keys: DataFrame, parent_col: str, n_named: int | None = None) -> DataFrame:
    """The parent keys that ``df`` names, checkpointed: for a batch that is small beside all parents.

    The batch's keys are combined before they are shuffled, so a hot key is one, and the join may broadcast them instead of
    shuffling all parents.  ``df`` is scanned for its key column alone, so it should be stored, not computed.
    ``n_named``: the number of its rows, where each names another key."""
    named = df.select(F.col(fk_col).alias("_named"))
    named = named.distinct() if n_named is None else held_by_task(named, n_named)
    return parent_keys.join(named, parent_keys[parent_col] == named["_named"], "left_semi").select(parent_col).checkpoint()


def route_valid(classified: DataFrame, reason_col: str = "_reason") -> DataFrame:
    return classified.filter(F.col(reason_col).isNull())


def route_quarantine(classified: DataFrame, reason_col: str = "_reason") -> DataFrame:
    return classified.filter(F.col(reason_col).isNotNull())


def normalize_empty(df: DataFrame, cols: list[str]) -> DataFrame:
    """'' -> NULL for the given optional text columns."""
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in cols})
