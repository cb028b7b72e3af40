"""The conversation trie against a plain construction."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from forgeline.llm import prefix_trie

DDL = "conv_id long, turn long, role string, text string, depth long, n_leaves string, member int"


def brute_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0, role or "", text or ""), (role or "", text or "")))
    own = {c: [said for _, said in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        donor = c - int(np.fmod(c, 5))
        rebuilt[c] = tuple(own.get(donor, [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, said in rebuilt.items():
        for d in range(len(said) + 1):
            members[said[:d]].append(c)
    children = Counter(n[:-1] for n in members if n)
    leaves, saved = Counter(), Counter()
    for n, m in members.items():
        for d in range(len(n) + 1):
            leaves[n[:d]] += children[n] == 0
            saved[n[:d]] += (len(m) - 1) * len(n[-1][1].encode()) if n else 0
    ends = lambda n: ",".join(str(c) for c in sorted(members[n]) if rebuilt[c] == n)
    return Counter((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), children[n], leaves[n], saved[n], hashlib.sha256(ends(n).encode()).hexdigest())
                   for n, m in members.items())


def conversations(seed=2):
    rng = random.Random(seed)
    say = lambda: rng.choice(["hello", "née", None, "", "what is it", "fine", "so so"])
    rows = []
    for c in [*range(-12, 90), 700, 1001, 1002, 1003]:
        if c % 11 != 3:
            rows += [(c, t, rng.choice(["user", "assistant", None]) if t else "user", say()) for t in range(rng.randint(1, 12))]
    rows += [(201, t, "user", f"turn {t}") for t in range(300)] + [(205, t, "user", f"turn {t % 7}") for t in range(120)]       # long chains
    rows += [(c, 0, "system", "common start") for c in range(300, 400)] + [(c, 1, "user", "again") for c in range(300, 400, 3)]  # one group of copies
    rows += [(20, None, "user", "no turn"), (20, None, "user", "no turn"), (20, 1, "user", "tie b"), (20, 1, "user", "tie a"), (None, 0, "user", "x"), (None, None, None, None), (21, None, None, None)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "l", 2) for r in rows], DDL).repartition(5)


NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.mark.parametrize("local_nodes", [50_000, 60])
def test_trie(spark, local_nodes):
    """With few nodes to a task, large components are split by joins first."""
    rows = conversations()
    got = prefix_trie.trie(frame(spark, rows), local_nodes)
    assert got.columns == NAMES
    assert Counter(map(tuple, got.collect())) == brute_trie(rows)


def test_small_tables(spark):
    assert prefix_trie.trie(frame(spark, [])).count() == 0
    assert prefix_trie.trie(frame(spark, [(None, 1, "user", "x")])).count() == 0
    one = [(7, 0, None, None)]
    assert Counter(map(tuple, prefix_trie.trie(frame(spark, one)).collect())) == brute_trie(one)
    big = [(c, t, "user", "z" * 1_100_000 if t == 9 else "s") for c in (5, 10) for t in range(10)]  # texts of over 1 MB
    assert Counter(map(tuple, prefix_trie.trie(frame(spark, big)).collect())) == brute_trie(big)


@pytest.mark.parametrize("shape", ["chain", "star", "random", "broom"])
def test_local_totals(shape):
    rng = random.Random(1)
    n = 3000
    parent = np.array([-1] + [{"chain": i - 1, "star": 0, "random": rng.randrange(i), "broom": i - 1 if i < n // 2 else n // 2 - 1}[shape] for i in range(1, n)])
    values = np.array([[rng.randrange(5), rng.randrange(100)] for _ in range(n)], np.int64)
    weight = np.ones(n, np.int64)
    want = values.copy()
    for i in range(n - 1, 0, -1):
        weight[parent[i]] += weight[i]
        want[parent[i]] += want[i]
    assert (prefix_trie.local_totals(parent < 0, parent, weight, values) == want).all()
