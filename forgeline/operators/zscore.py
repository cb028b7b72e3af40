"""Leave-one-out z-score per group, in closed form (no self-join, no per-row peer scan)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_EXACT = "decimal(38,0)"


def group_moments(df: DataFrame, group: str, value: str, sign: int = 1) -> DataFrame:
    """_group, _n, _s1, _s2: rows, sum and sum of squares per group (one partial aggregate), exact for whole numbers.

    Moments of disjoint row sets add up to those of their union; ``sign`` -1 makes moments that take rows away."""
    x = F.col(value).cast(_EXACT)
    return df.groupBy(F.col(group).alias("_group")).agg(
        (F.count(F.lit(1)) * sign).alias("_n"), (F.sum(x) * sign).cast(_EXACT).alias("_s1"), (F.sum(x * x) * sign).cast(_EXACT).alias("_s2"))


def merge_moments(*moments: DataFrame) -> DataFrame:
    """The sum of several moment tables; groups without rows are left out."""
    both = moments[0]
    for m in moments[1:]:
        both = both.unionByName(m)
    return both.groupBy("_group").agg(F.sum("_n").alias("_n"), F.sum("_s1").cast(_EXACT).alias("_s1"), F.sum("_s2").cast(_EXACT).alias("_s2")).where("_n > 0")


def loo_frame(df: DataFrame, group: str, value: str, moments: DataFrame | None = None) -> DataFrame:
    """Add, per row, the count, sum and sum of squares of the *other* rows of its group.

    Group totals (n, S1, S2) come from one partial aggregate; each row then subtracts
    itself.  Integer values give exact sums (DECIMAL(38,0)).  The totals are one row
    per group and are joined back (broadcast when the planner's size check allows).  Rows
    with a NULL group are each other's peers.  ``moments``: stored totals, for a ``df`` that holds some of the groups' rows only."""
    x = F.col(value).cast(_EXACT)
    totals = group_moments(df, group, value) if moments is None else moments
    return (df.join(totals, df[group].eqNullSafe(totals["_group"]))
            .withColumns({
                "peer_count": F.col("_n") - 1,
                "peer_sum": F.col("_s1") - x,
                "peer_sum_sq": F.col("_s2") - x * x,
            }).drop("_group", "_n", "_s1", "_s2"))


def loo_zscore(df: DataFrame, group: str, value: str, threshold: float = 2.5,
               prefix: str = "baseline_", flag: str = "is_baseline_anomaly",
               min_peers: int = 2, moments: DataFrame | None = None) -> DataFrame:
    """Mean and population standard deviation of the group's other rows, z-score of the
    row against them, and flag |z| > threshold.

    Fewer than ``min_peers`` other rows: mean, sd, z NULL and flag false.  Zero spread:
    mean kept, sd 0.0, z NULL, flag false.  With k peers, sum p and sum of squares q:
    mean = p / k and sd = sqrt(k*q - p^2) / k, where k*q - p^2 is computed exactly, so
    sd is 0 exactly when all peers are equal."""
    f = loo_frame(df, group, value, moments)
    k = F.col("peer_count")
    num = k.cast(_EXACT) * F.col("peer_sum_sq") - F.col("peer_sum") * F.col("peer_sum")
    enough = k >= min_peers
    mean = F.when(enough, F.col("peer_sum").cast("double") / k)
    sd = F.when(enough, F.sqrt(num.cast("double")) / k)
    out = f.withColumns({f"{prefix}mean": mean, f"{prefix}stddev": sd, "_spread": num})
    z = F.when(enough & (F.col("_spread") > 0),
               (F.col(value).cast("double") - F.col(f"{prefix}mean")) / F.col(f"{prefix}stddev"))
    out = out.withColumn(f"{prefix}z_score", z)
    return (out.withColumn(flag, F.coalesce(F.abs(F.col(f"{prefix}z_score")) > threshold, F.lit(False)))
            .drop("_spread", "peer_count", "peer_sum", "peer_sum_sq"))
