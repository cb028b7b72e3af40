"""Distributed isolation forest (Liu, Ting & Zhou, ICDM 2008).

Plan:
  1. per-tree samples without replacement: every row draws a number per tree, the md5 of (seed, tree, key);
     a tree's sample is its ``psi`` smallest draws.
     Rows are pre-filtered to draws below an over-sampling bound before the shuffle,
     then ranked per tree (partial WindowGroupLimit), so only ~psi rows per tree move.
     Trees that would come up short are redrawn without the pre-filter (exact).
  2. ``groupBy("tree").applyInPandas`` grows one tree per group (<= psi rows each).  A node's feature and split point
     are drawn from the md5 of (seed, tree, the node's path from the root), so any engine that has md5 grows the same forest.
  3. the forest (at most trees * (2*psi - 1) nodes, bounded by the parameters, not by
     the data) is broadcast and every row is scored by ``mapInPandas`` batch-wise.
Deterministic for a seed, independent of row order and partitioning.
"""

from __future__ import annotations

import hashlib
import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgeline.operators.topk import top_k_per_group

# The fit and score functions run in Python workers; ship this module's code with
# them (by value) so executors need nothing installed beyond numpy and pandas.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

EULER_GAMMA = 0.5772156649015329

NODE_SCHEMA = T.StructType([
    T.StructField("tree", T.IntegerType()), T.StructField("node", T.IntegerType()),
    T.StructField("feature", T.IntegerType()), T.StructField("threshold", T.DoubleType()),
    T.StructField("left", T.IntegerType()), T.StructField("right", T.IntegerType()),
    T.StructField("size", T.IntegerType()),
])


def average_path_length(n) -> np.ndarray:
    """c(n): mean path length of an unsuccessful search in a binary search tree of n keys."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    out[n == 2] = 1.0
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER_GAMMA) - 2.0 * (n[big] - 1.0) / n[big]
    return out


DRAW_DIGITS = 13  # hexadecimal digits of an md5 that make a draw: whole numbers that doubles hold exactly


def node_draw(seed: int, tree: int, what: str, path: str) -> int:
    """A number of 4 * DRAW_DIGITS bits for a node, named by its turns (L, R) from the root."""
    return int(hashlib.md5(f"{seed}|{tree}|{what}|{path}".encode()).hexdigest()[:DRAW_DIGITS], 16)


def grow_tree(X: np.ndarray, seed: int, tree: int, max_depth: int):
    """Random isolation tree: at each node pick a feature uniformly among the non-constant
    ones and a threshold uniformly between its min and max; x <= threshold goes left.
    Leaves at max_depth, at one row, or when every feature is constant."""
    feature, threshold, left, right, size = [], [], [], [], []

    def new_node(n):
        feature.append(-1)
        threshold.append(0.0)
        left.append(-1)
        right.append(-1)
        size.append(n)
        return len(feature) - 1

    root = new_node(len(X))
    stack = [(root, np.arange(len(X)), "")]
    while stack:
        nid, idx, path = stack.pop()
        if len(path) >= max_depth or len(idx) <= 1:
            continue
        sub = X[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        cand = np.flatnonzero(hi > lo)
        if cand.size == 0:
            continue
        f = int(cand[node_draw(seed, tree, "feature", path) % cand.size])
        t = float(lo[f] + node_draw(seed, tree, "split", path) / 16.0 ** DRAW_DIGITS * (hi[f] - lo[f]))
        t = t if t < hi[f] else float(lo[f])  # rounded up to the maximum: both sides keep a row
        go_left = sub[:, f] <= t
        li, ri = idx[go_left], idx[~go_left]
        feature[nid], threshold[nid] = f, t
        lnode, rnode = new_node(li.size), new_node(ri.size)
        left[nid], right[nid] = lnode, rnode
        stack.append((rnode, ri, path + "R"))
        stack.append((lnode, li, path + "L"))
    return feature, threshold, left, right, size


def _draw(seed: int, tree, key) -> F.Column:
    """A row's draw for a tree: 32 hexadecimal digits, whose order is that of the number."""
    return _draw_of(F.concat(F.lit(f"{seed}|"), tree.cast("string"), F.lit("|row|")), key)


def _draw_of(tree_text, key) -> F.Column:
    """The draw from the text that stands for the seed and the tree."""
    return F.md5(F.concat(tree_text, key.cast("string")).cast("binary"))


def tree_samples(df: DataFrame, key: str, features: list[str], trees: int, psi: int, n: int,
                 seed: int, only_trees: list[int] | None = None, prefilter: bool = True) -> DataFrame:
    """Rows (tree, key, features...) holding, per tree, the psi rows with smallest draw."""
    p = min(1.0, (psi + 8.0 * math.sqrt(psi) + 16.0) / max(n, 1)) if prefilter else 1.0
    # a row for each tree, whose draw generated code looks at (a lambda would be interpreted); few go further
    texts = F.array(*[F.struct(F.lit(t).alias("tree"), F.lit(f"{seed}|{t}|row|").alias("text"))
                      for t in (range(trees) if only_trees is None else only_trees)])
    cand = (df.select(F.col(key), *[F.col(c).cast("double").alias(c) for c in features], F.explode(texts).alias("_of"))
            .select(key, *features, F.col("_of.tree").alias("tree"), _draw_of(F.col("_of.text"), F.col(key)).alias("_u")))
    if p < 1.0:
        cand = cand.where(F.col("_u") < f"{int(p * 16 ** DRAW_DIGITS):0{DRAW_DIGITS}x}")
    return top_k_per_group(cand, ["tree"], [F.asc("_u"), F.asc(key)], psi, "_rank").drop("_rank", "_u")


def _fit_fn(features: list[str], seed: int, max_depth: int):
    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        X = pdf[features].to_numpy(dtype=float)
        f, t, lft, rgt, sz = grow_tree(X, seed, tree, max_depth)
        m = len(f)
        return pd.DataFrame({"tree": np.full(m, tree, dtype="int32"), "node": np.arange(m, dtype="int32"),
                             "feature": np.asarray(f, dtype="int32"), "threshold": np.asarray(t, dtype=float),
                             "left": np.asarray(lft, dtype="int32"), "right": np.asarray(rgt, dtype="int32"),
                             "size": np.asarray(sz, dtype="int32")})
    return fit


def fit_forest(df: DataFrame, key: str, features: list[str], trees: int = 100, max_samples: int = 256,
               seed: int = 42, n: int | None = None):
    """Grow the forest on executors; return the packed node arrays and psi."""
    n = df.count() if n is None else n
    psi = min(max_samples, n)
    max_depth = int(math.ceil(math.log2(max(psi, 2))))
    sample = tree_samples(df, key, features, trees, psi, n, seed).checkpoint(eager=True)
    # one row per tree (at most ``trees`` rows reach the driver)
    full = {r["tree"] for r in sample.groupBy("tree").count().filter(F.col("count") >= psi).collect()}
    redo = sorted(set(range(trees)) - full)
    if redo:  # exact fallback for trees the pre-filter left short
        sample = sample.filter(~F.col("tree").isin(redo)).unionByName(
            tree_samples(df, key, features, trees, psi, n, seed, only_trees=redo, prefilter=False))
    nodes = sample.groupBy("tree").applyInPandas(_fit_fn(features, seed, max_depth), NODE_SCHEMA)
    pdf = nodes.toPandas().sort_values(["tree", "node"])
    packed = []
    for _, g in pdf.groupby("tree", sort=True):
        packed.append(tuple(g[c].to_numpy() for c in ("feature", "threshold", "left", "right", "size")))
    return packed, psi, max_depth


def path_lengths(X: np.ndarray, packed, max_depth: int) -> np.ndarray:
    """Mean over trees of depth(x) + c(size of x's leaf)."""
    m = X.shape[0]
    rows = np.arange(m)
    total = np.zeros(m)
    for feat, thr, lft, rgt, size in packed:
        node = np.zeros(m, dtype=np.int64)
        depth = np.zeros(m)
        for _ in range(max_depth + 1):
            f = feat[node]
            inner = f >= 0
            if not inner.any():
                break
            go_left = X[rows, np.where(inner, f, 0)] <= thr[node]
            nxt = np.where(go_left, lft[node], rgt[node])
            node = np.where(inner, nxt, node)
            depth += inner
        total += depth + average_path_length(size[node])
    return total / len(packed)


def isolation_forest(df: DataFrame, key: str, features: list[str], trees: int = 100,
                     max_samples: int = 256, seed: int = 42, min_rows: int = 20,
                     score_col: str = "isolation_forest_score",
                     flag_col: str = "is_isolation_forest_anomaly") -> DataFrame:
    """All columns of ``df`` plus an anomaly score (offset so that < 0 means anomalous,
    range (-0.5, 0.5)) and a flag.  Under ``min_rows`` rows: score NULL, flag false."""
    n = df.count()
    out_schema = T.StructType(df.schema.fields + [T.StructField(score_col, T.DoubleType(), True),
                                                  T.StructField(flag_col, T.BooleanType(), False)])
    if n < min_rows:
        return df.withColumns({score_col: F.lit(None).cast("double"), flag_col: F.lit(False)})
    packed, psi, max_depth = fit_forest(df, key, features, trees, max_samples, seed, n)
    forest = df.sparkSession.sparkContext.broadcast((packed, max_depth))
    c_psi = float(average_path_length([psi])[0])

    def score(batches):
        trees_, depth_ = forest.value
        for pdf in batches:
            X = pdf[features].to_numpy(dtype=float)
            s = 0.5 - np.power(2.0, -path_lengths(X, trees_, depth_) / c_psi)
            pdf[score_col] = s
            pdf[flag_col] = s < 0
            yield pdf
    return df.mapInPandas(score, out_schema)
