"""Prefix trie of conversations, by a splitter skeleton.

A turn becomes a mark of 20 bytes: 16 of the SHA-256 of its role and text, 4 of
its number of words. The marks of a conversation, joined, are its path: paths
that start with the same turns start with the same bytes, so in sorted order the
members of a trie node are neighbours. Texts never move; paths do.

1. Range partitions. Paths are range-partitioned by (path, conversation) and
   sorted. A task cuts its rows into shards of at most ``SHARD_BYTES`` of path,
   whatever the skew; the first path of every shard is a splitter.
2. Skeleton. A node lies in several shards only if it is a prefix of a splitter
   path that the row before the splitter shares. The trie of the splitter paths
   is sent to every task in its depth form: for every shard, the turns that its
   splitter shares with the row before it, and with the last row of its shard.
   These two numbers a shard (24 bytes for ``SHARD_BYTES`` of paths) say which
   shards a skeleton node spans; the turns themselves are in the shard already.
3. Every shard finishes the nodes that lie in it alone, bottom up. Of a skeleton
   node it gives a partial aggregate: members, least member, children that start
   here, and the sums of the finished subtrees below. Partials are reduced by
   (shard where the node starts, depth).
4. Skeleton nodes in the order (start shard, depth) are in depth-first order, so
   the skeleton below a node is one interval: the rest of its start shard's chain
   and all of the shards up to its last. Subtree sums are a suffix sum and a
   difference of two prefix sums over one row per shard.

The member list of a node that ends a third of all conversations is not collected
either: shards give it in pieces, which a task hashes one after the other.

Defined results: a null role or text is empty; turns are ordered by turn number
(null first), those of the same number by mark; repeated rows are turns of their
own; rows without a conversation id belong to no conversation and are left out;
a conversation without turns is a member of the root alone; an empty table has
no nodes. Other columns are not read. Very long texts are hashed in the JVM and
go no further. One conversation's marks (20 bytes a turn) are one row: up to some
50 million turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docweave.llm.common import ASCII_WORD, bounded_batches, stage

#: bytes of a mark, and of it the turn's hash
MARK, HASH = 20, 16
#: bytes of paths (16 more a row) in one shard; the shards a partition of the sort holds
SHARD_BYTES, SHARDS_A_TASK = 2 << 20, 4
#: skeleton nodes whose least members may be broadcast (some 40 bytes each)
FEW_NODES = 100_000
SALTS = 64

EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def turn_lists(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
               text_col: str = "text") -> DataFrame:
    """(conv_id, marks): the marks of every conversation in order, as hexadecimal strings."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = conversations.select(F.col(f"`{id_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"),
                                role.alias("role"), text.alias("text")).where("conv_id is not null")
    # the role's length keeps ("a", "bc") apart from ("ab", "c")
    digest = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    words = F.lpad(F.hex(F.regexp_count("text", F.lit(ASCII_WORD)).cast("long")), 2 * (MARK - HASH), "0")
    rows = rows.select("conv_id", "turn", F.concat(digest.substr(1, 2 * HASH), words).alias("mark"))
    listed = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "mark"))).alias("t"))
    return listed.select("conv_id", F.transform("t", lambda x: x["mark"]).alias("marks"))


def shared_starts(lists: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Conversation c starts with the first h turns of conversation c - c % every
    (none if absent) and goes on with its own from h on; h = crc32(c) % most."""
    heads = (lists.where(F.col("conv_id") % every == 0)
             .select(F.col("conv_id").alias("__head"), F.slice("marks", 1, most - 1).alias("__marks")))
    both = (lists.withColumn("__of", F.col("conv_id") - F.col("conv_id") % every)
            .withColumn("__h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")))
    both = both.join(heads, F.col("__of") == F.col("__head"), "left")
    start = F.slice(F.coalesce("__marks", F.array().cast("array<string>")), F.lit(1), F.col("__h"))
    own = F.slice("marks", F.col("__h") + 1, F.greatest(F.size("marks"), F.lit(1)))
    return both.select("conv_id", F.concat(start, own).alias("marks"))


def _shared(a: bytes, b: bytes) -> int:
    """Turns that two paths share."""
    top = min(len(a), len(b)) // MARK
    if a[:top * MARK] == b[:top * MARK]:
        return top
    lo = 0
    while top - lo > 1:              # a[:lo] agrees, a[:top] does not
        mid = (lo + top) // 2
        if a[lo * MARK:mid * MARK] == b[lo * MARK:mid * MARK]:
            lo = mid
        else:
            top = mid
    return lo


def sorted_shards(lists: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(no, conv_id, path), written: shards of sorted paths, numbered in order."""
    import pyarrow as pa

    paths = stage(lists.select("conv_id", F.unhex(F.array_join("marks", "")).alias("path")), "paths")
    size = paths.agg(F.sum(F.length("path") + 16)).first()[0] or 0
    parts = max(1, -(-size // (shard_bytes * SHARDS_A_TASK)), min(paths.sparkSession.sparkContext.defaultParallelism, size >> 16))

    def cut(batches: Iterator) -> Iterator:
        from pyspark import TaskContext

        no, held = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            numbers = []
            for path in batch.column(1).to_pylist():
                held += len(path) + 16
                if held > shard_bytes:
                    no, held = no + 1, len(path) + 16
                numbers.append(no)
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), *batch.columns], names=["no", "conv_id", "path"])

    bounded_batches(paths.sparkSession)
    ordered = paths.repartitionByRange(int(parts), "path", "conv_id").sortWithinPartitions("path", "conv_id")
    return stage(ordered.mapInArrow(cut, "no bigint, conv_id bigint, path binary"), "shards")


def splitter_depths(shards: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(no, before, inside) in order: for every shard the turns that its first
    path shares with the row before it (-1 for the first shard), and with its own
    last path. One row of three numbers per shard reaches the driver."""
    @F.pandas_udf("int")
    def shared(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([-1 if x is None or y is None else _shared(x, y) for x, y in zip(a, b)], dtype="int32")

    ends = stage(shards.groupBy("no").agg(F.min("path").alias("first"), F.max("path").alias("last")), "splitters")
    place = ends.select("no", F.row_number().over(Window.orderBy("no")).alias("k"))     # one number per shard
    ends = ends.join(place, "no")
    after = ends.select((F.col("k") + 1).alias("k"), F.col("last").alias("ahead"))
    rows = (ends.join(after, "k", "left")
            .select("k", "no", shared("ahead", "first").alias("before"), shared("first", "last").alias("inside")).collect())
    rows.sort(key=lambda r: r.k)
    return tuple(np.array([r[c] for r in rows], np.int64) for c in ("no", "before", "inside"))


class Skeleton:
    """Which shards the nodes shared by neighbouring shards span."""

    def __init__(self, no: np.ndarray, before: np.ndarray, inside: np.ndarray):
        self.no, self.before, self.after = no, before, np.append(before[1:], -1)
        self.into, self.onto = np.minimum(before, inside), np.minimum(self.after, inside)

    def starts(self, k: int) -> list[int]:
        """For depths 0 to before[k]: the shard where the node that goes on into shard k starts."""
        least = np.minimum.accumulate(self.into[:k][::-1])          # over shards k-1, k-2, ...
        return [k - 1 - int(np.argmax(least < d)) for d in range(int(self.before[k]) + 1)]

    def last(self, k: int, depths: list[int]) -> list[int]:
        """The last shard of the nodes of these depths that start in shard k and go on."""
        least = np.minimum.accumulate(self.onto[k + 1:])
        return [k + 1 + int(np.argmax(least < d)) for d in depths]


LOCAL = ("skeleton boolean, k int, start int, depth bigint, parent_start int, last int, conv_id bigint, parent_conv_id bigint, "
         "n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, words bigint, ends_sha256 string, ends binary")


def finish_shard(rows: list[tuple[bytes, int]], k: int, skeleton: Skeleton) -> Iterator[tuple]:
    """The rows of ``LOCAL`` of one sorted shard: its own nodes, and its part of skeleton nodes."""
    depth, parent, words, first_end, ends = [0], [-1], [0], [0], [0]
    stack, prev = [0], b""
    for r, (path, _) in enumerate(rows):
        if path != prev:
            del stack[_shared(prev, path) + 1:]
            for d in range(len(stack), len(path) // MARK + 1):
                stack.append(len(depth))
                depth.append(d)
                parent.append(stack[-2])
                words.append(int.from_bytes(path[d * MARK - MARK + HASH:d * MARK], "big"))
                first_end.append(r)
                ends.append(0)
            prev = path
        ends[stack[-1]] += 1
    total, before, after = len(depth), int(skeleton.before[k]), int(skeleton.after[k])
    start = dict(enumerate(skeleton.starts(k)))             # the first path made the nodes 0, 1, 2, ... of these depths
    new = [x for x in stack[:after + 1] if x > before]
    last = dict(zip(new, skeleton.last(k, [depth[x] for x in new])))
    start |= dict.fromkeys(new, k)
    n, least = list(ends), [rows[first_end[x]][1] if ends[x] else None for x in range(total)]
    kids, leaves, saved = [0] * total, [0] * total, [0] * total
    for x in range(total - 1, -1, -1):                      # children come after their parent
        p = parent[x]
        if x not in start:
            saved[x] += (n[x] - 1) * words[x]
            leaves[x] = leaves[x] or 1
            if p >= 0:
                leaves[p] += leaves[x]
                saved[p] += saved[x]
        if p >= 0:
            n[p] += n[x]
            least[p] = least[x] if least[p] is None else min(least[p], least[x])
            kids[p] += x > before
    for x in range(total):
        p = parent[x]
        members = ",".join([str(rows[i][1]) for i in range(first_end[x], first_end[x] + ends[x])]).encode()
        mine = x in start
        yield (mine, k, start.get(x), depth[x], start.get(p), last.get(x), least[x],
               None if mine or p in start or p < 0 else least[p], n[x], kids[x], leaves[x], saved[x], words[x],
               None if mine else hashlib.sha256(members).hexdigest(), members if mine and members else None)


def member_hashes(pieces: DataFrame) -> DataFrame:
    """(start, depth, ends_sha256) of member lists in pieces (start, depth, k, ends):
    sorted, a task hashes a list piece by piece and holds none of it."""
    import pyarrow as pa

    def run(batches: Iterator) -> Iterator:
        key, state = None, None
        for batch in batches:
            done = []
            for s, d, ends in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
                if (s, d) == key:
                    state.update(b",")
                else:
                    if key:
                        done.append((*key, state.hexdigest()))
                    key, state = (s, d), hashlib.sha256()
                state.update(ends)
            yield from rows(done)
        if key:
            yield from rows([(*key, state.hexdigest())])

    def rows(done: list) -> Iterator:
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), (pa.int32(), pa.int64(), pa.string()))],
                                             names=["start", "depth", "ends_sha256"])

    ordered = pieces.select("start", "depth", "k", "ends").repartition("start", "depth").sortWithinPartitions("start", "depth", "k")
    return ordered.mapInArrow(run, "start int, depth bigint, ends_sha256 string")


def trie(lists: DataFrame, shard_bytes: int = SHARD_BYTES, few_nodes: int = FEW_NODES) -> DataFrame:
    """One row per trie node of (conv_id, marks): conv_id (least member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    import pyarrow as pa

    spark = lists.sparkSession
    shards = sorted_shards(lists, shard_bytes)
    depths = splitter_depths(shards)
    shared = spark.sparkContext.broadcast(depths)       # 24 bytes per shard
    schema = pa.schema([(c.split()[0], {"boolean": pa.bool_(), "int": pa.int32(), "bigint": pa.int64(), "string": pa.string(),
                                        "binary": pa.binary()}[c.split()[1]]) for c in LOCAL.split(", ")])

    def one(table):
        skeleton = Skeleton(*shared.value)
        k = int(np.searchsorted(skeleton.no, table["no"][0].as_py()))
        rows = sorted(zip(table["path"].to_pylist(), table["conv_id"].to_pylist()))
        columns = zip(*finish_shard(rows, k, skeleton))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    found = stage(shards.groupBy("no").applyInArrow(one, LOCAL), "nodes")
    parts = found.where("skeleton")
    total = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    nodes = parts.groupBy("start", "depth").agg(F.min("conv_id").alias("conv_id"), *total, *[
        F.max(c).alias(c) for c in ("words", "last", "parent_start")])
    nodes = stage(nodes.withColumn("n_leaves", F.col("n_leaves") + (F.col("n_children") == 0).cast("long"))
                  .withColumn("saved_tokens", F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("words")), "skeleton")
    sums = ["n_leaves", "saved_tokens"]
    below = Window.partitionBy("start").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = Window.orderBy("start").rowsBetween(Window.unboundedPreceding, Window.currentRow)     # one row per shard
    before = (spark.range(len(depths[0]) + 1).select(F.col("id").cast("int").alias("start"))
              .join(nodes.groupBy("start").agg(*[F.sum(c).alias(c) for c in sums]), "start", "left").na.fill(0, sums)
              .select("start", *[(F.sum(c).over(upto) - F.col(c)).alias(f"up_{c}") for c in sums]))
    low = before.select((F.col("start") - 1).alias("start"), *[F.col(f"up_{c}").alias(f"lo_{c}") for c in sums])
    high = before.select(F.col("start").alias("last"), *[F.col(f"up_{c}").alias(f"hi_{c}") for c in sums])
    hashes = member_hashes(parts.where("ends is not null"))
    whole = nodes.select("*", *[F.sum(c).over(below).alias(f"own_{c}") for c in sums]).drop(*sums)
    whole = (whole.join(low, "start").join(high, "last").join(hashes, ["start", "depth"], "left")
             .select("start", "depth", "parent_start", "conv_id", "n_convs", "n_children",
                     *[(F.col(f"own_{c}") + F.col(f"hi_{c}") - F.col(f"lo_{c}")).alias(c) for c in sums],
                     F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256")))

    # the least member of a parent in the skeleton; the root is the parent of a large part of all nodes
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    named = nodes.select(F.col("start").alias("parent_start"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("__least"))
    local = found.where("not skeleton").withColumn("__salt", F.col("k") % SALTS)
    if nodes.count() <= few_nodes:
        local = local.join(F.broadcast(named), ["parent_start", "depth"], "left")
    else:
        local = local.join(named.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))),
                           ["parent_start", "depth", "__salt"], "left")
    whole = whole.join(named, ["parent_start", "depth"], "left").withColumn("parent_conv_id", F.col("__least"))
    return (local.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "__least")).select(*out)
            .unionByName(whole.select(*out)))
