import numpy as np
import pytest
from conftest import SF0001

from docweave.llm import forest

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.95):
    ok = [i for i, (_, v, _) in enumerate(rows) if v and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    n, root = [0] * len(rows), list(range(len(rows)))
    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in ok:
        for j in ok:
            if i < j and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], np.float32).astype(float), np.array(rows[j][1], np.float32).astype(float)
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                    n[i] += 1
                    n[j] += 1
                    root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return sorted((r[0], n[i], least[find(i)]) for i, r in enumerate(rows))


def got(df):
    return sorted((r.id, r.n_links, r.component_id) for r in df.collect())


def test_equals_brute_force_on_the_table(spark):
    df = spark.read.parquet(f"{SF0001}/embeddings.parquet")
    out = forest.near_duplicates(df, leaf_aim=32)
    rows = [(r.vec_id, list(r.embedding) if r.embedding is not None else None, None) for r in df.collect()]
    want = brute(rows)
    have = got(out)
    found, true = sum(r[1] for r in have), sum(r[1] for r in want)
    assert 0.99 * true <= found <= true
    assert all(a[1] <= b[1] for a, b in zip(have, want))
    assert out.where("kept <> (id = component_id)").count() == 0


@pytest.mark.parametrize("leaf_rows", [10, 4096])
def test_edge_vectors_and_large_leaves(spark, leaf_rows):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(4, 8))
    rows = [(100 + i, (base[i % 4] + rng.normal(scale=0.05, size=8)).tolist(), 0) for i in range(60)]
    rows += [(200 + i, base[0].tolist(), 1) for i in range(15)] + [(7, (3 * base[0]).tolist(), 1), (7, base[0].tolist(), 1)]
    rows += [(1, None, 0), (2, [], 0), (3, [0.0] * 8, 0), (4, [None] + [1.0] * 7, 0), (5, [float("nan")] + [1.0] * 7, 0),
             (6, [float("inf")] + [1.0] * 7, 0), (8, [1.0, 0.0], 0), (9, [2.0, 0.0], 0), (10, [-0.0, 5.0], 0), (11, [0.0, 5.0], 0), (12, [1e-30] * 8, 0), (13, [3e38] * 8, 0)]
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, SCHEMA).repartition(4).withColumn("cls", F.lit("clash")).withColumn("id", F.lit(None)).withColumn("leaf", F.lit(1))
    assert got(forest.near_duplicates(df, leaf_aim=4, leaf_rows=leaf_rows, trees=6)) == brute(rows)


def test_empty_and_unusable_tables(spark):
    assert forest.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    only = spark.createDataFrame([(1, None, 0), (1, [0.0], 0)], SCHEMA)
    assert got(forest.near_duplicates(only)) == [(1, 0, 1), (1, 0, 1)]


def unit(x):
    return x / np.linalg.norm(x, axis=1)[:, None]


def planted(n, hot, pairs, dim=64, seed=1):
    """Unit vectors: n random ones, ``hot`` of them in one tight group, and
    ``pairs`` partners just over the threshold of the last ones."""
    rng = np.random.default_rng(seed)
    x = unit(rng.normal(size=(n, dim)))
    x[:hot] = unit(unit(rng.normal(size=(1, dim))) + 0.01 * rng.normal(size=(hot, dim)))
    a, cos = x[-pairs:], rng.uniform(0.9505, 0.97, pairs)[:, None]
    o = rng.normal(size=a.shape)
    o = unit(o - a * (o * a).sum(1)[:, None])
    return np.concatenate([x, cos * a + np.sqrt(1 - cos ** 2) * o])


@pytest.mark.parametrize("n, hot, most_copies", [(2_000, 0, 10), (20_000, 0, 16), (20_000, 7_000, 16), (60_000, 0, 20)])
def test_pair_work_and_recall_with_the_production_trees(n, hot, most_copies):
    pairs = 500
    x = planted(n, hot, pairs)
    sample = x[np.random.default_rng(2).permutation(len(x))[:forest.SAMPLE]]
    trees, margin = forest.plant(sample, len(x), 0.95, forest.TREES, forest.LEAF_AIM, 11)
    copies, work, met = 0, 0, np.zeros(pairs, bool)
    for tree in trees:
        assert (tree.child > 0).sum() >= 2 ** 4 - 1
        row, leaf = tree.leaves(x, margin)
        copies, work = copies + len(row), work + (np.bincount(leaf).astype(float) ** 2).sum() / 2
        at = [set() for _ in x[-2 * pairs:]]
        for r, k in zip(row.tolist(), leaf.tolist()):
            if r >= len(x) - 2 * pairs:
                at[r - len(x) + 2 * pairs].add(k)
        met |= [bool(a & b) for a, b in zip(at[:pairs], at[pairs:])]
    assert copies <= most_copies * len(x)
    assert work < len(x) ** 2 / 2
    assert met.mean() >= 0.99


def test_a_hot_group_equals_brute_force_in_split_trees(spark):
    x = planted(2_400, 800, 200).astype(np.float32)
    rows = [(i, v, 0) for i, v in enumerate(x.tolist())]
    have = got(forest.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(6), leaf_rows=500))
    y = unit(x.astype(float))
    near = y @ y.T >= 0.95
    np.fill_diagonal(near, False)
    assert sum(r[1] for r in have) >= 0.99 * near.sum()
    assert all(r[1] <= near[r[0]].sum() for r in have)
    assert [r[1:] for r in have[:800]] == [(int(near[i].sum()), 0) for i in range(800)]


def test_many_vector_lengths_need_no_tree_each(spark):
    rows = [(i, [1.0] * (1 + i // 2), 0) for i in range(120)] + [(500 + i, [float(i)] + [1.0] * 70, 0) for i in range(3)]
    assert got(forest.near_duplicates(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
