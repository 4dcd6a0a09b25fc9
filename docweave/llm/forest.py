"""Embedding near-dedup with a forest of random-projection trees.

Equal vectors collapse to one class first. Every tree splits recursively by a
random direction; a vector closer to a split than the spill margin goes down
both sides. The margin is half of the spread that two vectors at the threshold
have along a random direction, so a pair is parted by one split seldom and by
every tree almost never. A node of the bounded sample is cut where its two
children, spilled vectors in both, make the fewest comparisons, and stays a leaf
where no cut saves a tenth of them: a cut goes beside a tight group, never
through it, so a group as tight as the margin is not copied down both sides
again and again. The trees (directions and split points) are the only thing
that reaches all tasks, and their size is bounded by the sample; every vector is
routed through them. Beyond ``SAMPLE / SAMPLE_LEAF`` leaves per tree, leaves grow
with the table.

Vectors that share a leaf are compared by cosine in double precision, in
blocks. A pair that shares several leaves is counted in the smallest of them
only, so nothing per pair leaves a task: a leaf yields, for each class, the
number of vectors linked to it and one edge into its local component. Rows are
ordered by their earlier leaves, and two blocks that lie in one earlier leaf
whole are not multiplied again, so the trees compare a large tight group about
once, not once each. Counts are summed, edges are united by connected components.

A leaf with more than ``LEAF_ROWS`` classes is dealt in hash blocks of that
size, each pair of blocks compared in its own task: the same pairs, spread.
A length with at most ``LEAF_AIM`` classes is one leaf and grows no tree.

Defined results: vectors that are null, empty, zero, or hold null or non-finite
components link with nothing (component: their own id, 0 links). Vectors of
different lengths never link. Repeated rows and equal vectors link with each
other. Null ids never name a component unless there is no other. An empty table
gives no rows. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.common import bounded_batches, components, stage

#: vectors that fit the trees at most, sample vectors of a leaf at least
SAMPLE, SAMPLE_LEAF = 32_768, 8
#: aim for the classes of a leaf, and classes of one comparison task at most
LEAF_AIM, LEAF_ROWS = 128, 4096
TREES = 4
#: spill margin over the spread of a pair at the threshold; a split must leave this part of the comparisons at most
MARGIN, WORTH = 0.5, 0.9
#: rows of one side of a matrix product
SIDE = 512


@dataclass
class Tree:
    """Node k has children ``child[k]`` and ``child[k] + 1``, or is a leaf (0)."""
    directions: np.ndarray
    cuts: np.ndarray
    child: np.ndarray

    def leaves(self, x: np.ndarray, margin: float) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) pairs; unit vectors x go both ways within the margin."""
        row, node = np.arange(len(x)), np.zeros(len(x), np.int64)
        rows, leaves = [], []
        while len(row):
            ends = self.child[node] == 0
            rows.append(row[ends])
            leaves.append(node[ends])
            row, node = row[~ends], node[~ends]
            gap = np.empty(len(row))
            for s in range(0, len(row), 65_536):
                part = slice(s, s + 65_536)
                gap[part] = np.einsum("ij,ij->i", x[row[part]], self.directions[node[part]]) - self.cuts[node[part]]
            left, right = gap < margin, gap >= -margin
            row, node = np.concatenate([row[left], row[right]]), np.concatenate([self.child[node[left]], self.child[node[right]] + 1])
        return np.concatenate(rows), np.concatenate(leaves)


def best_cut(at: np.ndarray, margin: float) -> float | None:
    """The cut of projections ``at`` whose children make the fewest comparisons
    (spilled rows count in both), among quantiles and evenly spaced values;
    None where no cut is worth a split."""
    at = np.sort(at)
    cuts = np.concatenate([at[np.arange(1, 16) * len(at) // 16], np.linspace(at[0], at[-1], 17)[1:-1]])
    cuts = cuts[cuts > at[0]]
    if not len(cuts):
        return None
    left = np.searchsorted(at, cuts + margin).astype(float)
    right = len(at) - np.searchsorted(at, cuts - margin).astype(float)
    cost = left * left + right * right
    k = int(cost.argmin())
    return float(cuts[k]) if cost[k] <= WORTH * len(at) ** 2 else None


def grow(x: np.ndarray, leaf: float, margin: float, seed: int) -> Tree:
    """A tree of the sample's unit vectors x whose nodes split while they hold
    more than ``leaf`` of them and a cut is worth it."""
    rng = np.random.default_rng(seed)
    directions, cuts, child = [np.zeros(x.shape[1])], [0.0], [0]
    todo = [(0, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        if len(rows) <= leaf:
            continue
        direction = rng.normal(size=x.shape[1])
        direction /= np.linalg.norm(direction)
        at = x[rows] @ direction
        cut = best_cut(at, margin)
        if cut is None:
            continue
        directions[node], cuts[node], child[node] = direction, cut, len(child)
        for part in (rows[at < cut], rows[at >= cut]):
            todo.append((len(child), part))
            directions.append(np.zeros(x.shape[1]))
            cuts.append(0.0)
            child.append(0)
    return Tree(np.array(directions), np.array(cuts), np.array(child))


def plant(x: np.ndarray, total: int, threshold: float, trees: int, leaf_aim: int, seed: int) -> tuple[list[Tree], float]:
    """The trees of a table of ``total`` classes, fitted on unit vectors x, and their margin."""
    margin = MARGIN * np.sqrt(2 * (1 - threshold) / x.shape[1])
    leaf = max(leaf_aim * len(x) / total, min(SAMPLE_LEAF, leaf_aim))
    return [grow(x, leaf, margin, seed + t) for t in range(trees)], margin


def usable(vec) -> F.Column:
    """Not null, not empty, all components finite, not all zero."""
    return F.coalesce(vec.isNotNull() & F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
                      & F.exists(vec, lambda v: v != 0), F.lit(False))


def _vectors(column) -> np.ndarray:
    flat = column.values if not hasattr(column, "chunks") else column.combine_chunks().values
    return np.asarray(flat.to_numpy(zero_copy_only=False), dtype=float).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1)[:, None]      # no overflow in the squares
    return x / np.sqrt((x * x).sum(1))[:, None]


def _local(a_rows: np.ndarray, b_rows: np.ndarray, n: int) -> np.ndarray:
    """Smallest row of the component of each of n rows, over links (a, b)."""
    root = np.arange(n)
    while True:
        before = root.copy()
        least = np.minimum(root[a_rows], root[b_rows])
        np.minimum.at(root, a_rows, least)
        np.minimum.at(root, b_rows, least)
        root = root[root]
        if (root == before).all():
            return root


def _share(a: list[list[int]], b: list[list[int]]) -> np.ndarray:
    """Which rows of a share a leaf with which rows of b."""
    place = {v: k for k, v in enumerate({v for e in a for v in e} & {v for e in b for v in e})}
    member = [np.zeros((len(side), len(place)), np.float32) for side in (a, b)]
    for m, side in zip(member, (a, b)):
        for k, e in enumerate(side):
            m[k, [place[v] for v in e if v in place]] = 1
    return member[0] @ member[1].T > 0.5


def compare(key: tuple, rows, threshold: float):
    """Links inside one leaf, or between two blocks of one: rows is an Arrow
    table (leaf, i, j, block, cls, n, embedding, leaves)."""
    import pyarrow as pa

    leaf, i, j = (int(k.as_py()) for k in key)
    cls, n, block = (rows[c].to_numpy() for c in ("cls", "n", "block"))
    earlier = [[v for v in sorted(e) if v < leaf] for e in rows["leaves"].to_pylist()]
    order = sorted(range(len(cls)), key=lambda k: (block[k], earlier[k], cls[k]))
    cls, n, block, earlier = cls[order], n[order], block[order], [earlier[k] for k in order]
    x = _unit(_vectors(rows["embedding"]))[order]
    first = int((block == min(i, j)).sum()) if i != j else len(cls)

    def sides(start: int, end: int) -> list[tuple[int, int, set]]:
        return [(s, min(s + SIDE, end), set.intersection(*map(set, earlier[s:min(s + SIDE, end)]))) for s in range(start, end, SIDE)]

    count, root = np.zeros(len(cls), np.int64), np.arange(len(cls))
    above = sides(0, first)
    for k, (a0, a1, whole) in enumerate(above):
        for b0, b1, other in (above[k:] if i == j else sides(first, len(cls))):     # inside one block: the upper triangle only
            if whole & other:
                continue
            near = x[a0:a1] @ x[b0:b1].T >= threshold
            if not near.any():
                continue
            p, q = near.any(1).nonzero()[0], near.any(0).nonzero()[0]
            near = near[np.ix_(p, q)] & ~_share([earlier[a0 + v] for v in p], [earlier[b0 + v] for v in q])
            u, v = np.nonzero(near)
            p, q = p[u] + a0, q[v] + b0
            if i == j:
                p, q = p[p < q], q[p < q]
            np.add.at(count, p, n[q])
            np.add.at(count, q, n[p])
            root = np.minimum(root, _local(np.concatenate([p, root]), np.concatenate([q, np.arange(len(cls))]), len(cls)))
    has = (count > 0)
    return pa.table({"cls": pa.array(cls[has], pa.int64()), "links": pa.array(count[has], pa.int64()), "root": pa.array(cls[root][has], pa.int64())})


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.95,
                    trees: int = TREES, leaf_aim: int = LEAF_AIM, leaf_rows: int = LEAF_ROWS, seed: int = 11) -> DataFrame:
    """(id, n_links, component_id, kept) per row of ``vectors``."""
    import pyarrow as pa

    spark = vectors.sparkSession
    bounded_batches(spark)
    vec = F.col(f"`{vec_col}`")
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), F.when(usable(vec), vec).alias("embedding"))
    classes = stage(rows.where("embedding is not null").groupBy("embedding")
                    .agg(F.min("id").alias("least_id"), F.count(F.lit(1)).alias("n"))
                    .withColumn("cls", F.monotonically_increasing_id()).withColumn("dim", F.size("embedding")), "classes")

    forests = {}
    for dim, total in classes.groupBy("dim").count().where(F.col("count") > leaf_aim).collect():     # one row per vector length that splits
        take = classes.where(F.col("dim") == dim).select("embedding").orderBy(F.xxhash64("embedding"), "embedding").limit(SAMPLE).toArrow()
        forests[dim] = plant(_unit(_vectors(take["embedding"])), total, threshold, trees, leaf_aim, seed + 1000 * dim)
    shared = spark.sparkContext.broadcast(forests)

    def route(batches: Iterator) -> Iterator:
        forest_of = shared.value
        for batch in batches:
            dims = batch.column(3).to_numpy(zero_copy_only=False)
            for dim in np.unique(dims).tolist():
                own = batch.filter(pa.array(dims == dim))
                x, leaves = _unit(_vectors(own.column(2))), [[] for _ in range(own.num_rows)]
                at, leaf = [], []
                grown, margin = forest_of.get(dim, ([Tree(np.zeros((1, 1)), np.zeros(1), np.zeros(1, np.int64))], 0.0))
                for t, tree in enumerate(grown):
                    r, k = tree.leaves(x, margin)
                    k = (dim << 40) + (t << 32) + k
                    at.append(r)
                    leaf.append(k)
                    for a, b in zip(r.tolist(), k.tolist()):
                        leaves[a].append(b)
                at, leaf = np.concatenate(at), np.concatenate(leaf)
                for s in range(0, len(at), 4096):
                    pick = pa.array(at[s:s + 4096])
                    part = own.take(pick)
                    yield pa.RecordBatch.from_arrays([pa.array(leaf[s:s + 4096], pa.int64()), part.column(0), part.column(1), part.column(2),
                                                      pa.array([leaves[a] for a in at[s:s + 4096].tolist()], pa.list_(pa.int64()))],
                                                     names=["leaf", "cls", "n", "embedding", "leaves"])

    kind = classes.schema["embedding"].dataType.simpleString()
    routed = stage(classes.select("cls", "n", "embedding", "dim")
                   .mapInArrow(route, f"leaf bigint, cls bigint, n bigint, embedding {kind}, leaves array<bigint>"), "routed")
    blocks = routed.groupBy("leaf").count().select("leaf", F.ceil(F.col("count") / leaf_rows).cast("int").alias("blocks")).where("blocks > 1")
    block = F.when(F.col("blocks").isNull(), 0).otherwise(F.expr("cast(pmod(xxhash64(cls), blocks) as int)"))
    dealt = (routed.join(blocks, "leaf", "left").withColumn("block", block)
             .withColumn("with", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)))
             .select("leaf", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "block", "cls", "n", "embedding", "leaves"))
    found = stage(dealt.groupBy("leaf", "i", "j").applyInArrow(lambda key, t: compare(key, t, threshold), "cls bigint, links bigint, root bigint"), "links")

    roots = components(found.select(F.col("cls").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    known = (classes.select("embedding", "cls", "least_id", "n").join(links, "cls", "left")
             .join(roots, F.col("cls") == F.col("node"), "left").withColumn("root", F.coalesce("root", "cls")).drop("node"))
    named = known.groupBy("root").agg(F.min("least_id").alias("component_id"))
    of_class = (known.join(named, "root")
                .select(F.col("embedding").alias("__vec"), (F.coalesce("links", F.lit(0).cast("long")) + F.col("n") - 1).alias("n_links"), "component_id"))
    return (rows.join(of_class, F.col("embedding") == F.col("__vec"), "left")
            .select("id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
                    F.when(F.col("__vec").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))
            .withColumn("kept", F.col("id").eqNullSafe(F.col("component_id"))))
