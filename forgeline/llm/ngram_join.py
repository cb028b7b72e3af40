"""Similarity join of documents on sets of word n-grams, by prefix filters under several global token orders.

A document's tokens are its distinct n-grams (its whole word sequence, if shorter).  Two sets whose Jaccard
similarity reaches the threshold share a token among the first size - ceil(threshold * size) + 1 of each, under any order
of all tokens.  Tokens are ordered by document frequency, rarest first, and ties by one of ORDERS hashes: each is a
global order of its own.  A pair is a candidate when its prefixes meet under all of them, and then its whole sets
are compared.

1. Equal sets become one node.  2. Blocks of documents ask shards for their tokens' document frequencies.  A node
whose prefix holds unshared tokens only (the rarest come first) has no partner.  3. Of every other node the shared
tokens and the prefixes are kept.  4. All nodes with a token in the first order's prefix are compared with one of
them, its leader; links make components.  5. While some token's nodes lie in different components, its nodes are compared
across components; the join that meets them already leaves out pairs whose sketches differ in more places than linked
sets can.  So no link between components is lost, and pairs within a component are not needed for it.  6. A link's ends lie in one component, so the links of a node are counted
there: components are dealt into chunks, and every two chunks of one are compared whole, by products of their incidence
matrices.  Only counts leave a task, but the work grows with the square of a component's different texts.

Null and empty texts have no tokens and link with nothing.  Rows with a null doc_id are left out of the links.
Rows are told apart by their sets: those with equal doc_id and other texts share the component of either.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgeline.llm.blocks import BLOB, BLOCK_BYTES, SHARD_BYTES, Dealt, answered, blob_table, cuts, planes, replies, unplanes
from forgeline.llm.components import components
from forgeline.llm.textbatch import inside, mix64, ngrams, parse, word_hashes

N = 5
PERCENT = 80
ORDERS = 3
CHUNK_NODES = 512        # of a component, compared at once with another chunk
CHUNK_TOKENS = 2_000_000
SKETCH = 16              # longs of a node's sketch: the parity of its shared tokens in each of 64 * SKETCH places
_COLUMNS = 2048          # of the incidence matrices held at once
_KEY_BYTES = 5  # of a token's hash, beside its shard, in frequency questions: a clash only makes a token look less rare


def token_sets(col, n: int = N):
    """Sorted distinct token hashes of each text, one after the other, the texts' offsets, and two hashes of each whole set."""
    b = parse(col, lower=True)
    h = word_hashes(b)
    texts = len(b)
    s = ngrams(h, n)
    ok = inside(b, n)
    key, doc = [s[ok]], [b.doc[:len(ok)][ok]]
    for size in range(1, n):  # short texts: the whole sequence
        own = np.flatnonzero(b.n_words == size)
        if len(own):
            total = ngrams(h, size, seed=101 + size)[b.first[own]]
            key.append(total)
            doc.append(own)
    key, doc = np.concatenate(key), np.concatenate(doc)
    order = np.lexsort((key, doc))
    key, doc = key[order], doc[order]
    new = np.concatenate(([True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1]))) if len(key) else np.zeros(0, bool)
    key, doc = key[new], doc[new]
    first = np.searchsorted(doc, np.arange(texts + 1))
    totals = [np.concatenate(([np.uint64(0)], np.cumsum(mix64(key ^ np.uint64(x))))) for x in (0x51, 0xA7)]
    s1, s2 = ((t[first[1:]] - t[first[:-1]]).view(np.int64) for t in totals)
    return key, first, s1, s2


def prefix_size(n):
    """How many tokens of n must hold a shared one: n - ceil(PERCENT% of n) + 1."""
    return n - -(-n * PERCENT // 100) + 1


def frequency_class(df: np.ndarray) -> np.ndarray:
    """Document frequencies in one byte, in their order."""
    return np.where(df <= 200, df, np.minimum(200 + 4 * np.log2(np.maximum(df, 200) / 200), 255)).astype(np.uint8)


def _frequencies(bits: int):
    def answer(blobs: list[bytes]) -> list[bytes]:
        size = [len(x) // (_KEY_BYTES + 1) for x in blobs]
        key = np.concatenate([unplanes(x, n, "<u8", _KEY_BYTES) for x, n in zip(blobs, size)])
        own = np.concatenate([np.frombuffer(x[_KEY_BYTES * n:], np.uint8) for x, n in zip(blobs, size)])
        _, which = np.unique(key, return_inverse=True)
        df = frequency_class(np.bincount(which, weights=own).astype(np.int64))[which]
        at = np.cumsum([0, *size])
        return [df[i:j].tobytes() for i, j in zip(at[:-1], at[1:])]
    return answer


class _Nodes:
    """The sets that a block's documents stand for."""

    def __init__(self, table: pa.Table, got: pa.Table):
        wanted = {(d, s) for d, s, k in zip(got.column("doc_id").to_pylist(), got.column("node").to_pylist(), got.column("kind").to_pylist()) if k == 0}
        self.key, first, s1, _ = token_sets(table.column("text"))
        self.node = []
        self.span = []
        for i, (doc, s) in enumerate(zip(table.column("doc_id").to_pylist(), s1.tolist())):
            if (doc, s) in wanted:
                wanted.discard((doc, s))
                self.node.append(s)
                self.span.append((first[i], first[i + 1]))
        self.tokens = np.concatenate([self.key[i:j] for i, j in self.span]) if self.span else np.zeros(0, np.uint64)
        self.size = np.array([j - i for i, j in self.span], np.int64)

    def distinct(self):
        return np.unique(self.tokens, return_inverse=True, return_counts=True)


_ASK = BLOB + ", doc_id long, node long"
_SHARED = "node long, size long, weight double, sketch array<long>, tokens array<long>, " + ", ".join(f"prefix{o} array<long>" for o in range(ORDERS))


def _lists(values: np.ndarray, count: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(count))), pa.int32()), pa.array(values.view(np.int64)))


def _sketches(tokens: np.ndarray, node: np.ndarray, n: int) -> pa.Array:
    """For each of n nodes, whether an odd number of its tokens fall into a place, for 64 * SKETCH places."""
    place = (mix64(tokens ^ np.uint64(0x5EED)) % np.uint64(64 * SKETCH)).astype(np.int64)
    at, times = np.unique(node * (64 * SKETCH) + place, return_counts=True)
    bits = np.zeros((n, 64 * SKETCH), np.uint8)
    bits.ravel()[at[times % 2 == 1]] = 1
    return _lists(np.packbits(bits, axis=1).view(np.uint64).ravel(), np.full(n, SKETCH))


def shared_parts(nodes: _Nodes, got: pa.Table, bits: int) -> pa.Table:
    """Of each node that may have a partner: its size, the weight, sketch and list of its shared tokens, and their prefixes under each order."""
    keys, which, _ = nodes.distinct()
    edge = cuts(keys, bits)
    df = np.ones(len(keys), np.uint8)
    for s, raw in replies(got, 1).items():
        df[edge[s]:edge[s + 1]] = np.frombuffer(raw, np.uint8)
    df = df[which]
    node = np.repeat(np.arange(len(nodes.size)), nodes.size)
    first = np.cumsum(nodes.size) - nodes.size
    some = np.bincount(node[df == 1], minlength=len(nodes.size)) < prefix_size(nodes.size)
    shared = (df > 1) & some[node]
    prefixes = []
    for o in range(ORDERS):
        order = np.lexsort((mix64(nodes.tokens ^ np.uint64(0x1000 + o)), df, node))
        place = np.arange(len(order)) - np.repeat(first, nodes.size)
        taken = order[(place < prefix_size(nodes.size)[node]) & shared[order]]
        prefixes.append(_lists(nodes.tokens[taken], np.bincount(node[taken], minlength=len(nodes.size))[some]))
    weight = np.bincount(node, weights=np.log2(df), minlength=len(nodes.size)).astype(float)
    held = np.cumsum(some) - 1
    return pa.table([pa.array(np.array(nodes.node, np.int64)[some]), pa.array(nodes.size[some]), pa.array(weight[some]),
                     _sketches(nodes.tokens[shared], held[node[shared]], int(some.sum())), _lists(nodes.tokens[shared], np.bincount(node[shared], minlength=len(nodes.size))[some]), *prefixes],
                    names=["node", "size", "weight", "sketch", "tokens", *(f"prefix{o}" for o in range(ORDERS))])


def _may_link(a: str, b: str) -> Column:
    """Can two nodes reach the threshold?  Only tokens that some other node has can be common to both."""
    return _reach(F.least(F.col(f"{a}shared"), F.col(f"{b}shared")), F.col(f"{a}size"), F.col(f"{b}size"))


def _reach(both: Column, a_size: Column, b_size: Column) -> Column:
    """Does a number of common tokens reach the threshold?"""
    return both * 100 >= (a_size + b_size - both) * PERCENT


def _alike(a: str, b: str) -> Column:
    """Can two nodes reach the threshold by their sketches?  Each place that differs holds a shared token that only one of them has."""
    apart = sum((F.bit_count(F.col(f"{a}sketch")[i].bitwiseXOR(F.col(f"{b}sketch")[i])) for i in range(SKETCH)), F.lit(0))
    both = F.floor((F.col(f"{a}shared") + F.col(f"{b}shared") - apart) / 2)
    return _reach(both, F.col(f"{a}size"), F.col(f"{b}size"))


def _prefixes_meet(order: int) -> Column:
    """Do the prefixes under an order hold enough common tokens?

    The prefix that ends first in the order holds all common tokens up to its end, so those beyond the
    prefixes' own common ones are at most what the longer rest of the two holds.
    """
    rest = lambda size: F.ceil(size * PERCENT / 100) - 1  # noqa: E731  (tokens after the prefix)
    both = F.size(F.array_intersect(f"a_prefix{order}", f"b_prefix{order}"))
    return (both > 0) & _reach(both + F.greatest(rest(F.col("a_size")), rest(F.col("b_size"))), F.col("a_size"), F.col("b_size"))


def linked(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) that meet in all orders' prefixes and whose sets reach the threshold."""
    side = lambda x, cols: nodes.select(F.col("node").alias(x), *(F.col(c).alias(f"{x}_{c}") for c in cols))
    prefixes = ["size", *(f"prefix{o}" for o in range(ORDERS))]
    met = pairs.join(side("a", prefixes), "a").join(side("b", prefixes), "b")
    for o in range(ORDERS):
        met = met.where(_prefixes_meet(o))
    sets = ["size", "tokens"]
    both = F.size(F.array_intersect("a_tokens", "b_tokens"))
    return (met.select("a", "b").join(side("a", sets), "a").join(side("b", sets), "b")
            .where(_reach(both, F.col("a_size"), F.col("b_size"))).select("a", "b"))


def link_components(nodes: DataFrame) -> DataFrame:
    """node and component of every linked node, of nodes with their shared tokens, sketches and prefixes."""
    at = nodes.select("node", "size", F.size("tokens").alias("shared"), "weight", "sketch", F.explode("prefix0").alias("token"))
    lead = (at.groupBy("token").agg(F.max(F.struct("weight", "node", "size", "shared")).alias("lead"), F.count("*").alias("n"))
            .where("n > 1").select("token", "lead").checkpoint())
    pairs = (at.drop("sketch").join(lead, "token").where(F.col("lead.node") != F.col("node")).where(_may_link("lead.", ""))
             .select(F.col("lead.node").alias("a"), F.col("node").alias("b")).distinct())
    links = linked(pairs, nodes).checkpoint()
    found = components(links)
    # tokens whose nodes still lie in several components: every pair across them that may link is to be compared
    of = at.select("token", "node").join(lead.select("token"), "token").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    open_tokens = of.groupBy("token").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least <> most").select("token").checkpoint()
    across = (at.join(open_tokens, "token").join(found, "node", "left")
              .select("token", "node", "size", "shared", "sketch", F.coalesce("component", "node").alias("component")).checkpoint())
    other = across.select("token", *(F.col(c).alias(f"b_{c}") for c in ("node", "size", "shared", "sketch", "component")))
    apart = (F.col("component") != F.col("b_component")) & (F.col("node") < F.col("b_node"))
    rest = (across.join(other, (across["token"] == other["token"]) & apart & _may_link("", "b_") & _alike("", "b_"))
            .select(F.col("node").alias("a"), F.col("b_node").alias("b")).distinct())
    more = linked(rest, nodes).checkpoint()
    if not more.isEmpty():
        found = components(links.unionByName(more).distinct().checkpoint())
    return found


def _chunk_links(key, table):
    """node, n_links: the links between two chunks of a component, or within one."""
    chunk, size, node = (table.column(c).to_numpy() for c in ("chunk", "size", "node"))
    tokens = table.column("tokens").combine_chunks()
    value = tokens.flatten().to_numpy()
    row = np.repeat(np.arange(len(node)), np.diff(tokens.offsets.to_numpy()))
    _, column, times = np.unique(value, return_inverse=True, return_counts=True)
    some = times[column] > 1
    row, column = row[some], np.unique(column[some], return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    a, b = np.flatnonzero(chunk == key[1].as_py()), np.flatnonzero(chunk == key[2].as_py())
    place = np.zeros(len(node), np.int64)
    place[a], place[b] = np.arange(len(a)), np.arange(len(b))
    in_a, in_b = chunk[row] == key[1].as_py(), chunk[row] == key[2].as_py()
    common = np.zeros((len(a), len(b)), np.float32)  # exact: no set has 2^24 tokens
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS):
        own = slice(*np.searchsorted(column, (lo, lo + _COLUMNS)))
        left, right = np.zeros((len(a), _COLUMNS), np.float32), np.zeros((len(b), _COLUMNS), np.float32)
        for held, side in ((left, in_a[own]), (right, in_b[own])):
            held[place[row[own][side]], column[own][side] - lo] = 1
        common += left @ right.T
    both = common.astype(np.int64)
    link = (both * 100 >= (size[a][:, None] + size[b][None, :] - both) * PERCENT) & (node[a][:, None] != node[b][None, :])
    out = [(node[a], link.sum(axis=1))] + ([(node[b], link.sum(axis=0))] if key[1] != key[2] else [])
    return pa.table([pa.array(np.concatenate([x[i] for x in out]).astype(np.int64)) for i in (0, 1)], names=["node", "n_links"])


def link_counts(nodes: DataFrame, found: DataFrame, chunk_nodes: int = CHUNK_NODES, chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """node and the exact number of other nodes it links with, of every node of a component."""
    held = nodes.select("node", "size", "tokens").join(found, "node")
    chunks = (held.groupBy("component").agg(F.count("*").alias("n"), F.sum(F.size("tokens")).alias("n_tokens"))
              .select("component", F.ceil(F.greatest(F.col("n") / chunk_nodes, F.col("n_tokens") / chunk_tokens)).cast("int").alias("chunks")))
    dealt = (held.join(chunks, "component").withColumn("chunk", F.pmod(F.xxhash64("node"), "chunks").cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))))
    low, high = F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high")
    return (dealt.select("component", low, high, "chunk", "node", "size", "tokens").groupBy("component", "low", "high")
            .applyInArrow(_chunk_links, "node long, n_links long").groupBy("node").agg(F.sum("n_links").alias("n_links")))


def join_components(docs: DataFrame, block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES, counted: bool = True) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) and, if counted, the exact number of other sets
    that its set links with (n_links), for every row."""
    dealt = Dealt(docs, block_bytes, shard_bytes)
    bits = dealt.bits

    def fingerprints(batches):
        for b in batches:
            _, first, s1, s2 = token_sets(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("blk"), pa.array(np.diff(first)), pa.array(s1), pa.array(s2)],
                                             names=["doc_id", "blk", "n_shingles", "node", "check"])

    rows = dealt.docs.mapInArrow(fingerprints, "doc_id long, blk int, n_shingles long, node long, check long").checkpoint()
    usable = rows.where("n_shingles > 0 and doc_id is not null")
    sets = usable.groupBy("node", "check", "n_shingles").agg(F.min(F.struct("doc_id", "blk")).alias("one")).select("node", "one.doc_id", "one.blk")
    wanted = sets.select("blk", F.lit(0).alias("shard"), F.lit(0).alias("kind"), F.lit(None).cast("binary").alias("blob"), "doc_id", "node").checkpoint()
    blocks = dealt.docs.groupBy("blk")

    def ask(key, table, got):
        if not table.num_rows:
            return blob_table(0, 1, iter(()))
        keys, _, times = _Nodes(table, got).distinct()
        edge, low = cuts(keys, bits), keys << np.uint64(bits) >> np.uint64(64 - 8 * _KEY_BYTES)
        times = np.minimum(times, 255).astype(np.uint8)
        return blob_table(key[0].as_py(), 1, ((s, planes(low[i:j].astype("<u8"), _KEY_BYTES) + times[i:j].tobytes())
                                              for s, (i, j) in enumerate(zip(edge[:-1], edge[1:])) if j > i))

    def gather(key, table, got):
        return shared_parts(_Nodes(table, got), got, bits)

    frequencies = answered(blocks.cogroup(wanted.groupBy("blk")).applyInArrow(ask, BLOB), 1, _frequencies(bits))
    both = wanted.unionByName(frequencies.withColumn("doc_id", F.lit(None).cast("long")).withColumn("node", F.lit(None).cast("long")))
    nodes = blocks.cogroup(both.groupBy("blk")).applyInArrow(gather, _SHARED).dropDuplicates(["node"]).checkpoint()
    found = link_components(nodes)
    member = (usable.select("node", "doc_id").join(found, "node", "left").withColumn("component", F.coalesce("component", "node")))
    least = member.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_node = found.join(least, "component").select("node", F.col("component_id").alias("by_link"))
    own = usable.groupBy("node").agg(F.min("doc_id").alias("by_set"))
    known = own.join(of_node, "node", "left").select("node", F.coalesce("by_link", "by_set").alias("component_id"))
    if counted:
        known = known.join(link_counts(nodes, found).checkpoint(), "node", "left")
    n_links = [F.coalesce("n_links", F.lit(0)).alias("n_links")] if counted else []
    return (rows.withColumn("set", F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("node"))).join(known.withColumnRenamed("node", "set"), "set", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), *n_links))


def one_of_each(docs: DataFrame) -> DataFrame:
    """docs without the rows whose doc_id links to a smaller one; null doc_ids and texts without words stay."""
    others = join_components(docs, counted=False).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(others, docs["doc_id"].cast("long") == others["doc_id"], "left_anti")
