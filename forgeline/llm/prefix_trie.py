"""Prefix trie of conversations, rolled up by centroid decomposition of its parent edges.

A node is a distinct sequence of a conversation's first d turns; its members are the conversations that start with it.  A node is named
by its smallest member and its depth, so the members of the trie's paths name each other and no text is kept.

1. ``rebuild`` deals a group's shared turns to its conversations; every turn becomes two hashes and a byte count.
2. The first d turns of a conversation are the xor of d positioned 128-bit hashes, a running window; equal ones are one node.
   A conversation's row at depth d names its node, so the row before it names the parent, and a join with the
   rows of a node's smallest member tells its ancestor at any depth.
3. Totals over subtrees (leaves, saved tokens) come from a centroid decomposition.  The weight of a subtree is the number of
   conversation turns in it, which a plain aggregate gives.  While a component has more than LOCAL_NODES nodes, it is split at
   its centroid, the deepest node with half of its weight or more: what lies below each of the centroid's children
   becomes a component of its own, the part above stays, and no part has more than half of the weight.  The total of the centroid's part is
   added along the path from the centroid to the component's top, and taken off the weights there.
   So a component of any shape is small after logarithmically many rounds, long chains and wide fans alike.
4. Components of at most LOCAL_NODES nodes are dealt into groups of about that size, and each task goes on splitting them in the same way.
5. The ends of a node (members without further turns) are hashed in ascending order as a stream, so that a task holds one batch of a
   node that very many copies end at.

Null roles and texts count as empty; turns are ordered by turn (null first), then role and text, and repeated rows are turns of their own.
Rows without conv_id are left out; an empty table has no nodes, not even a root.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

GROUP = 5
MOST_SHARED = 9
LOCAL_NODES = 50_000
NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, at (place in the conversation, from 1), two hashes of role and text, bytes of the text."""
    rows = (conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                 *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")))
            .where("conv_id is not null"))
    said = F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"))
    half = lambda i: F.conv(F.substring(said, i, 16), 16, -10).cast("long")
    place = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    return rows.select("conv_id", F.row_number().over(place).cast("long").alias("at"), half(1).alias("k1"), half(17).alias("k2"),
                       F.octet_length("text").cast("long").alias("bytes"))


def rebuild(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, k1, k2, bytes) of the rebuilt conversations' turns, and every conv_id with its length.

    A conversation c starts with the first h turns of c - c % GROUP, h = crc32(c) % MOST_SHARED, and goes on with its own after the first h.
    """
    own = turns(conversations).checkpoint()
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_SHARED
    every = (own.groupBy("conv_id").agg(F.max("at").alias("own_turns"))
             .select("conv_id", "own_turns", (F.col("conv_id") - F.col("conv_id") % GROUP).alias("donor"), h.alias("h")).checkpoint())
    donors = every.select(F.col("conv_id").alias("donor"), F.col("own_turns").alias("donor_turns"))
    every = every.join(donors, "donor", "left").withColumn("shared", F.least("h", F.coalesce("donor_turns", F.lit(0))))
    given = own.where(F.col("at") < MOST_SHARED).withColumnRenamed("conv_id", "donor").join(every.select("conv_id", "donor", "shared"), "donor").where("at <= shared")
    rest = own.join(every.select("conv_id", "h", "shared"), "conv_id").where("at > h")
    cols = ["k1", "k2", "bytes"]
    rows = (given.select("conv_id", F.col("at").alias("depth"), *cols)
            .unionByName(rest.select("conv_id", (F.col("at") - F.col("h") + F.col("shared")).alias("depth"), *cols)))
    return rows, every.select("conv_id", (F.col("shared") + F.greatest(F.col("own_turns") - F.col("h"), F.lit(0))).alias("turns"))


def paths(rows: DataFrame, lengths: DataFrame, root: int) -> tuple[DataFrame, DataFrame]:
    """The trie's nodes (conv_id, depth, parent_conv_id, n_convs, bytes, weight), and its paths: the node (conv_id) of every
    rebuilt conversation (member) at every depth, its parent_conv_id, and whether the member ends there."""
    place = Window.partitionBy("conv_id").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    so_far = lambda *key: F.bit_xor(F.xxhash64(*key)).over(place)
    keyed = (rows.withColumn("p1", so_far("depth", "k1", "k2")).withColumn("p2", so_far("k2", F.lit("second"), "k1", "depth"))
             .join(lengths, "conv_id").select("conv_id", "depth", "p1", "p2", "bytes", "turns").checkpoint())
    key = ["depth", "p1", "p2"]
    below = F.sum(F.col("turns") - F.col("depth") + 1).alias("weight")  # every turn that a member has from here on
    found = keyed.groupBy(key).agg(F.min("conv_id").alias("node"), F.count("*").alias("n_convs"), F.max("bytes").alias("bytes"), below).checkpoint()
    none = F.lit(0).cast("long")
    top = lengths.withColumn("depth", none).agg(F.lit(root).cast("long").alias("conv_id"), none.alias("depth"), F.count("*").alias("n_convs"), none.alias("bytes"), below)
    ends = (F.col("depth") == F.col("turns")).alias("ends")
    before = Window.partitionBy("member").orderBy("depth")
    members = (keyed.join(found.select(*key, "node"), key).select(F.col("conv_id").alias("member"), "depth", F.col("node").alias("conv_id"), ends)
               .unionByName(lengths.select(F.col("conv_id").alias("member"), none.alias("depth"), F.lit(root).cast("long").alias("conv_id"), (F.col("turns") == 0).alias("ends")))
               .withColumn("parent_conv_id", F.lag("conv_id").over(before)).checkpoint())
    parents = members.where("member = conv_id").select("conv_id", "depth", "parent_conv_id")
    nodes = found.select(F.col("node").alias("conv_id"), "depth", "n_convs", "bytes", "weight").unionByName(top).join(parents, ["conv_id", "depth"])
    return nodes, members


def local_totals(top: np.ndarray, parent: np.ndarray, weight: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Totals of every node's subtree within its component, by centroid decomposition.

    parent: the place of each node's parent in the same component, or -1; nodes are ordered so that parents come first.
    """
    n = len(parent)
    total = np.zeros_like(values)
    children: list[list[int]] = [[] for _ in range(n)]
    for i, p in enumerate(parent.tolist()):
        if p >= 0:
            children[p].append(i)
    up = parent.tolist()
    below = weight.tolist()             # of the subtree within the component that is being split
    gone = [False] * n
    todo = np.flatnonzero(top).tolist()
    while todo:
        root = todo.pop()
        all_of, centroid = below[root], root
        while True:                     # down the heavy side while it has half of the weight or more
            heavy = max((c for c in children[centroid] if not gone[c]), key=below.__getitem__, default=None)
            if heavy is None or 2 * below[heavy] < all_of:
                break
            centroid = heavy
        part, stack = np.zeros(values.shape[1], values.dtype), [centroid]
        while stack:
            v = stack.pop()
            part += values[v]
            stack += [c for c in children[v] if not gone[c]]
        v, off = centroid, below[centroid]
        while True:
            total[v] += part
            if v == root:
                break
            v = up[v]
            below[v] -= off
        gone[centroid] = True
        todo += [c for c in children[centroid] if not gone[c]]
        if centroid != root:
            todo.append(root)
    return total


def _split_locally(table: pa.Table) -> pa.Table:
    cols = {c: table.column(c).to_numpy() for c in ("conv_id", "depth", "parent_conv_id", "top_conv_id", "top_depth", "weight", "n_leaves", "saved_tokens")}
    order = np.lexsort((cols["conv_id"], cols["depth"]))
    cols = {k: v[order] for k, v in cols.items()}
    place = {k: i for i, k in enumerate(zip(cols["conv_id"].tolist(), cols["depth"].tolist()))}
    top = (cols["conv_id"] == cols["top_conv_id"]) & (cols["depth"] == cols["top_depth"])
    parent = np.array([-1 if t else place[p, d - 1] for t, p, d in zip(top.tolist(), cols["parent_conv_id"].tolist(), cols["depth"].tolist())], np.int64)
    total = local_totals(top, parent, cols["weight"], np.stack([cols["n_leaves"], cols["saved_tokens"]], axis=1))
    return pa.table([cols["conv_id"], cols["depth"], total[:, 0], total[:, 1]], names=["conv_id", "depth", "n_leaves", "saved_tokens"])


def subtree_totals(nodes: DataFrame, members: DataFrame, local_nodes: int = LOCAL_NODES) -> DataFrame:
    """conv_id, depth, and n_leaves and saved_tokens over every node's subtree.

    nodes: those of one tree, with the weight of their subtrees and their own n_leaves and saved_tokens; members: its paths.
    """
    values, name, top = ["n_leaves", "saved_tokens"], ["conv_id", "depth"], ["top_conv_id", "top_depth"]
    root = nodes.where("depth = 0").select(F.col("conv_id").alias("top_conv_id"), F.col("depth").alias("top_depth"))
    state = nodes.select(*name, "parent_conv_id", "weight", *values).join(F.broadcast(root), F.col("depth") >= F.col("top_depth")).checkpoint()
    size = state.count()
    added = []
    while True:
        large = state.groupBy(top).agg(F.count("*").alias("n"), F.max("weight").alias("all_of")).where(F.col("n") > local_nodes).drop("n").checkpoint()
        if large.isEmpty():
            break
        open_nodes = state.join(large, top)
        centroids = (open_nodes.where("2 * weight >= all_of").groupBy(top).agg(F.max(F.struct("depth", "conv_id", "weight")).alias("c"))
                     .select(*top, F.col("c.conv_id").alias("c_conv_id"), F.col("c.depth").alias("c_depth"), F.col("c.weight").alias("c_weight")).checkpoint())
        # what is below the centroid passes one of its children on the way
        way = members.select(F.col("member").alias("conv_id"), (F.col("depth") - 1).alias("c_depth"), F.col("conv_id").alias("child"), F.col("parent_conv_id").alias("c_conv_id"))
        is_below = (F.col("depth") > F.col("c_depth")) & F.col("child").isNotNull()
        is_centroid = (F.col("conv_id") == F.col("c_conv_id")) & (F.col("depth") == F.col("c_depth"))
        sided = (state.join(centroids, top, "left").join(way, ["conv_id", "c_depth", "c_conv_id"], "left")
                 .withColumn("below", F.coalesce(is_below, F.lit(False))).withColumn("centroid", F.coalesce(is_centroid, F.lit(False))).checkpoint())
        part = sided.where("below or centroid").groupBy(top).agg(*(F.sum(c).alias(c) for c in values))
        split = centroids.join(part, top).checkpoint()
        up = (split.join(members.select(F.col("member").alias("c_conv_id"), "conv_id", "depth"), "c_conv_id")
              .where("depth >= top_depth and depth <= c_depth").select(*name, "c_weight", *values).checkpoint())
        added.append(up.select(*name, *values))
        state = (sided.where("not centroid").join(up.select(*name, F.col("c_weight").alias("off")), name, "left")
                 .select(*name, "parent_conv_id", (F.col("weight") - F.coalesce("off", F.lit(0))).alias("weight"), *values,
                         F.when(F.col("below"), F.col("child")).otherwise(F.col("top_conv_id")).alias("top_conv_id"),
                         F.when(F.col("below"), F.col("c_depth") + 1).otherwise(F.col("top_depth")).alias("top_depth")).checkpoint())
    groups = max(1, -(-size // local_nodes))
    rest = (state.withColumn("group", F.pmod(F.xxhash64(*top), F.lit(groups)).cast("int")).groupBy("group")
            .applyInArrow(_split_locally, "conv_id long, depth long, n_leaves long, saved_tokens long"))
    for one in added:
        rest = rest.unionByName(one)
    return rest.groupBy(name).agg(*(F.sum(c).alias(c) for c in values))


def _digests(batches):
    """conv_id, depth, ends_sha256 of rows ordered by node and member."""
    node, digest, out = None, None, []
    for rows in batches:
        for conv, depth, member in zip(*(rows.column(c).to_pylist() for c in ("conv_id", "depth", "member"))):
            if (conv, depth) != node:
                if node:
                    out.append((*node, digest.hexdigest()))
                node, digest = (conv, depth), hashlib.sha256(str(member).encode())
            else:
                digest.update(f",{member}".encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["conv_id", "depth", "ends_sha256"])
            out = []
    if node:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, digest.hexdigest())], names=["conv_id", "depth", "ends_sha256"])


def ends(members: DataFrame) -> DataFrame:
    """conv_id, depth and the digest of the members that end there, of every node with some."""
    return (members.where("ends").select("conv_id", "depth", "member").repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "member")
            .mapInArrow(_digests, "conv_id long, depth long, ends_sha256 string"))


def trie(conversations: DataFrame, local_nodes: int = LOCAL_NODES) -> DataFrame:
    """Every node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    rows, lengths = rebuild(conversations)
    lengths = lengths.checkpoint()
    root = lengths.agg(F.min("conv_id").alias("root")).first()["root"]
    if root is None:
        return conversations.sparkSession.createDataFrame([], NODES)
    nodes, members = paths(rows, lengths, root)
    children = (nodes.where("depth > 0").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children")))
    nodes = (nodes.join(children, ["conv_id", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
             .withColumn("n_leaves", (F.col("n_children") == 0).cast("long")).withColumn("saved_tokens", (F.col("n_convs") - 1) * F.col("bytes")).checkpoint())
    totals = subtree_totals(nodes, members, local_nodes)
    return (nodes.drop("n_leaves", "saved_tokens").join(totals, ["conv_id", "depth"]).join(ends(members), ["conv_id", "depth"], "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")))
