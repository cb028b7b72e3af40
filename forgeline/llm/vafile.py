"""Exact top-k inner products by vector-approximation files.

Every vector is turned into integers (floor(scale * x)) and approximated: its components fall into CELLS equal cells
between its own lowest and highest integer, a byte each.

1. Scan: approximations and queries are dealt into bounded blocks; each block of queries meets each block of
   approximations in one task.  The cells' edges bound every inner product from above and below.  A block hands on the
   pairs that its k best lower bounds do not rule out.
2. The k best lower bounds of a query over all blocks rule out most of these.
3. Read: the exact vectors of the pairs left are read in order of their bounds.  The first k give each query an
   exact kth score; of the others, only those are read whose bound still reaches it.  Then the kth result is certain.

(For inner products the largest score is wanted, so pairs are read by descending upper bound.)  Exact vectors never meet
the blocks; they are joined to the surviving pairs alone.  Of very many rows with one vector, only the k + 1 smallest ids can be
among any query's best k, as equal scores go to the smaller id; the others are left out before the scan.

Rows whose vector is null, empty, of another length than the query's, or holds a null or non-finite component take no
part; null ids neither.  Repeated ids are kept as separate candidates (never matched to a query with the same id); a
repeated query row is asked once, and two query rows of one id with different vectors get a list each.
Bounds are whole numbers in doubles: a component beyond sqrt(2^53 / length), where they might not be exact, raises an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 8192
QUERY_BLOCK = 1024
CELLS = 256  # at most, a byte holds them
_PAIR = "q long, query_id long, place long, vec_id long, lower long, upper long"


def integers(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id and the integer components (array<long>) of every usable row."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"))
    odd = F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    v = v.where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0) & ~odd)
    most = F.sqrt(F.lit(2.0 ** 53) / F.size("x"))
    large = F.exists("x", lambda c: F.abs(c * F.lit(float(scale))) >= most - 1)
    whole = F.transform("x", lambda c: F.floor(c * F.lit(float(scale))).cast("long"))
    return v.select("vec_id", F.when(large, F.raise_error(F.lit("a component is too large for exact inner products"))).otherwise(whole).alias("x"))


def approximations(v: DataFrame, cells: int = CELLS) -> DataFrame:
    """place, vec_id, dim and, in place of x, its lowest integer, the width of its cells and the cell of each component."""
    low, high = F.array_min("x"), F.array_max("x")
    v = v.select("place", "vec_id", "x", F.size("x").alias("dim"), low.alias("low"), F.expr(f"({cells - 1} + array_max(x) - array_min(x) + 1) div {cells}").alias("width"))
    return v.select("place", "vec_id", "dim", "low", "width", F.expr("transform(x, c -> cast((c - low) div width - 128 as tinyint))").alias("cell"))


def _matrix(column: pa.ChunkedArray, n: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, -1).astype(float)


def block_pairs(q: pa.Table, v: pa.Table, k: int) -> pa.Table:
    """The pairs of a block of queries and a block of approximations that may be among a query's best k, with their bounds."""
    v = v.sort_by("vec_id")
    ids, places = v.column("vec_id").to_numpy(), v.column("place").to_numpy()
    low, width = (v.column(c).to_numpy().astype(float) for c in ("low", "width"))
    cell, queries = _matrix(v.column("cell"), len(v)) + 128, _matrix(q.column("x"), len(q))
    q_ids, q_places = q.column("vec_id").to_numpy(), q.column("q").to_numpy()
    found: list[np.ndarray] = []
    for lo in range(0, len(queries), 128):
        part = queries[lo:lo + 128]
        base = part.sum(axis=1)[:, None] * low + (part @ cell.T) * width  # of the cells' lower edges
        lower = base + np.minimum(part, 0).sum(axis=1)[:, None] * (width - 1)
        upper = base + np.maximum(part, 0).sum(axis=1)[:, None] * (width - 1)
        own = q_ids[lo:lo + 128, None] == ids
        lower[own] = upper[own] = -np.inf
        least = np.partition(lower, len(ids) - k, axis=1)[:, len(ids) - k] if len(ids) > k else np.full(len(part), -np.inf)
        for i in range(len(part)):
            at = np.flatnonzero((upper[i] >= least[i]) & (upper[i] > -np.inf))
            if least[i] > -np.inf:  # equal bounds: the smaller ids
                even = np.flatnonzero(lower[i] == least[i])
                last = even[k - 1 - np.count_nonzero(lower[i] > least[i])]
                at = at[(upper[i][at] > least[i]) | (ids[at] <= ids[last])]
            n = len(at)
            found.append(np.stack([np.full(n, q_places[lo + i]), np.full(n, q_ids[lo + i]), places[at], ids[at],
                                   lower[i][at].astype(np.int64), upper[i][at].astype(np.int64)]))
    return pa.table(list(np.concatenate(found, axis=1)), names=["q", "query_id", "place", "vec_id", "lower", "upper"])


def scan(q: DataFrame, cells: DataFrame, k: int, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """The pairs (q, query_id, place, vec_id, lower, upper) that the bounds of all approximations leave for the best k."""
    n_v, n_q = (max(1, -(-df.count() // size)) for df, size in ((cells, block), (q, query_block)))
    deal = lambda key, n: F.pmod(F.xxhash64(key), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = q.select("q", "vec_id", "x", F.size("x").alias("dim"), deal("q", n_q).alias("qb"), every(n_v).alias("vb"))
    right = cells.select("*", deal("place", n_v).alias("vb"), every(n_q).alias("qb"))

    def run(key, queries, vectors):
        if not queries.num_rows or not vectors.num_rows:
            return pa.table([pa.array([], pa.int64())] * 6, names=["q", "query_id", "place", "vec_id", "lower", "upper"])
        return block_pairs(queries, vectors, k)

    keys = ["qb", "vb", "dim"]
    near = left.groupBy(keys).cogroup(right.groupBy(keys)).applyInArrow(run, _PAIR).checkpoint()
    order = Window.partitionBy("q").orderBy(F.desc("lower"), "vec_id", "place")
    kth = (near.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k).where(F.col("n") == k)
           .select("q", F.col("lower").alias("least"), F.col("vec_id").alias("least_id")))
    reaches = F.col("least").isNull() | (F.col("upper") > F.col("least")) | ((F.col("upper") == F.col("least")) & (F.col("vec_id") <= F.col("least_id")))
    return near.join(kth, "q", "left").where(reaches).drop("least", "least_id")


def read(pairs: DataFrame, q: DataFrame, v: DataFrame) -> DataFrame:
    """The pairs with their exact score."""
    product = F.aggregate(F.zip_with("x", "qx", lambda a, b: a * b), F.lit(0).cast("long"), lambda s, c: s + c)
    return (pairs.join(v.select("place", "x"), "place").join(q.select("q", F.col("x").alias("qx")), "q")
            .select("q", "query_id", "vec_id", "place", product.alias("score")))


def prepared(vectors: DataFrame, queries: DataFrame, k: int, scale: int = 256) -> tuple[DataFrame, DataFrame]:
    """The distinct query rows (q, vec_id, x) and the vectors (place, vec_id, x), numbered."""
    rows = integers(vectors, scale).groupBy("x", "vec_id").agg(F.count("*").alias("n"))  # equal rows meet before the exchange
    first = Window.partitionBy("x").orderBy("vec_id")
    rows = rows.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= k + 1)
    rows = rows.select("vec_id", "x", F.explode(F.sequence(F.lit(1), F.least("n", F.lit(k)).cast("int"))).alias("copy")).drop("copy")
    v = rows.withColumn("place", F.monotonically_increasing_id()).checkpoint()
    q = integers(queries, scale).dropDuplicates().withColumn("q", F.monotonically_increasing_id()).checkpoint()
    return q, v


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256, cells: int = CELLS, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score of the k highest integer inner products of each query row with the other rows."""
    q, v = prepared(vectors, queries, k, scale)
    by_bound = Window.partitionBy("q").orderBy(F.desc("upper"), "vec_id", "place")
    left = scan(q, approximations(v, cells), k, block, query_block).withColumn("turn", F.row_number().over(by_bound)).checkpoint()
    best = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id", "place")
    head = read(left.where(F.col("turn") <= k), q, v).checkpoint()
    kth = head.groupBy("q").agg(F.min("score").alias("least"))
    more = read(left.where(F.col("turn") > k).join(kth, "q").where("upper >= least"), q, v)
    ranked = head.unionByName(more).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
