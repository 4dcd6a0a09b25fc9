"""Every node of small tries against a plain loop over all prefixes."""
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from docweave.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def mark_order(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]


def brute_force(rows, every=20):
    lists = {}
    for c, t, role, text in rows:
        if c is not None:
            lists.setdefault(c, []).append((t is not None, t or 0, mark_order(role or "", text or ""), role or "", text or ""))
    own = {c: [x[3:] for x in sorted(v)] for c, v in lists.items()}
    made = {}
    for c in own:
        h, base = zlib.crc32(str(c).encode()) % 4, c - int(math.fmod(c, every))
        made[c] = own.get(base, [])[:h] + own[c][h:]
    nodes, kids = {}, {}
    for c, p in made.items():
        for d in range(len(p) + 1):
            nodes.setdefault(tuple(p[:d]), []).append(c)
    for p in nodes:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    out, leaves, saved = [], {}, {}
    for p in sorted(nodes, key=len, reverse=True):
        members, below = nodes[p], kids.get(p, [])
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        leaves[p] = sum(leaves[k] for k in below) or 1
        saved[p] = (len(members) - 1) * words + sum(saved[k] for k in below)
        ends = ",".join(map(str, sorted(c for c in members if len(made[c]) == len(p))))
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(below), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(seed):
    """Null turns, roles and texts, ties, a null id, a third of all conversations equal, deep equal ones, a long text."""
    rng, rows = random.Random(seed), []
    for c in range(240):
        for t in range(rng.choice([0, 1, 1, 2, 3, 5])):
            rows.append((c, t if rng.random() > 0.1 else None, rng.choice(["u", None, "a"]), rng.choice(["x y", "x y", "x\ty", "z", None, ""])))
    rows += [(c, t, "u", "same same") for c in range(240, 360) for t in range(6)]
    rows += [(c, t, "u", f"deep {t % 2}") for c in (2000, 2001, 2020) for t in range(60)]
    return rows + [(None, 1, "u", "a"), (-5, 0, "u", "x y"), (1000, 0, "u", "w " * 50_000), (7, 1, "u", "tie"), (7, 1, "u", "tie")]


@pytest.mark.parametrize("shard_bytes,few", [(1 << 21, 100_000), (300, 100_000), (300, 0), (4000, 0)])
def test_nodes_equal_brute_force(spark, shard_bytes, few):
    """One shard, shards of a few rows (every hot node in the skeleton), and both ways to a parent's id."""
    rows = conversations(shard_bytes)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS mark", "'x' AS path", "2 AS no", "3 AS `a.b`")
    lists = prefix_trie.shared_starts(prefix_trie.turn_lists(df.repartition(3)))
    got = sorted((tuple(r) for r in prefix_trie.trie(lists, shard_bytes, few).collect()), key=str)
    assert got == brute_force(rows)


def test_empty_and_single(spark):
    none = prefix_trie.turn_lists(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA))
    assert prefix_trie.trie(none).collect() == []
    one = prefix_trie.trie(prefix_trie.turn_lists(spark.createDataFrame([(3, None, None, None)], SCHEMA))).orderBy("depth").collect()
    assert [(r.conv_id, r.depth, r.parent_conv_id, r.n_children, r.n_leaves) for r in one] == [(3, 0, None, 1, 1), (3, 1, 3, 0, 1)]


def test_shared_turns():
    rng = random.Random(2)
    for _ in range(300):
        a, b = (b"".join(rng.choice([b"x", b"y"]) * prefix_trie.MARK for _ in range(rng.randrange(9))) for _ in range(2))
        marks = [[p[i:i + prefix_trie.MARK] for i in range(0, len(p), prefix_trie.MARK)] for p in (a, b)]
        want = next((i for i, (x, y) in enumerate(zip(*marks)) if x != y), min(map(len, marks)))
        assert prefix_trie._shared(a, b) == want


def test_skeleton_spans():
    """Start and last shard of every node against a walk over the shards."""
    rng = random.Random(4)
    for _ in range(200):
        n = rng.randrange(2, 9)
        before = np.array([-1] + [rng.randrange(4) for _ in range(n - 1)])
        inside = np.array([rng.randrange(5) for _ in range(n)])
        s = prefix_trie.Skeleton(np.arange(n), before, inside)
        for k in range(1, n):
            for d, got in enumerate(s.starts(k)):
                j = k - 1
                while before[j] >= d and inside[j] >= d:
                    j -= 1
                assert got == j
        for k in range(n - 1):
            depths = list(range(int(before[k + 1]) + 1))
            for d, got in zip(depths, s.last(k, depths)):
                j = k + 1
                while j + 1 < n and inside[j] >= d and before[j + 1] >= d:
                    j += 1
                assert got == j
