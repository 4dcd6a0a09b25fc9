"""SimHash near-dedup with deletion-variant signatures.

A fingerprint has one bit per position where over half of the XXH64 hashes of
a text's word shingles have a 1. Two fingerprints at most ``max_bits`` = 2 bits
apart, cut into 2 segments of 32 bits, have a segment that differs by at most
one bit. Every fingerprint is therefore indexed under each segment with each
single bit left out (2 x 32 variants); an equality join on the variants finds
all pairs, which are then verified by their bit distance.

A pair is taken only at the variant of its differing bit (at the first variant
where the segments agree), so it appears at most once per segment. Equal
fingerprints are one node from the start.

A variant shared by more than ``bucket_cap`` fingerprints is not joined with
itself. Inside it the pairs are those that agree in the segment and differ by
at most two bits in the other, or differ in the left-out bit and by at most one
in the other; grouping the members by the other segment with two (one) bits
left out puts exactly such pairs together, and everyone links to the smallest
member of its group: a true link each time, linear in the members, and the
components are the same.

Defined results: null and empty texts, and texts without words, have
fingerprint zero and link like any other; texts of fewer words than a shingle
are one shingle. component_id is the smallest id reachable (null ids are never
it, unless there is no other). Repeated rows are rows of their own. An empty
table gives no rows. Other columns are never read. A very long text is read whole
by its row's task, its hashes counted in steps of 8,192 shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docweave.llm.common import bounded_batches, components, keep_rows, stage, text_hash

LOW = (1 << 32) - 1
#: members of a variant that are joined with each other; larger ones take the grouped way
BUCKET_CAP = 256


def simhash_bytes(raw: bytes | None, words: int, seed: int) -> int:
    """Fingerprint (signed 64 bit) of one text."""
    import numpy as np
    import xxhash

    w = (raw or b"").lower().split()   # both are ASCII only on bytes
    if not w:
        return 0
    line, lens = b" ".join(w), np.fromiter(map(len, w), np.int64, len(w))
    ends = np.cumsum(lens + 1) - 1
    starts = ends - lens
    k = max(1, len(w) - words + 1)
    pairs = zip(starts[:k].tolist(), ends[min(words, len(w)) - 1:].tolist())
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(line[s:e], seed) for s, e in pairs], dtype=np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, k, 8192):
        part = h[i:i + 8192].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits((ones * 2 > k).astype(np.uint8), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = 3, seed: int = 42, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id, raw, fp) per row."""
    import pyarrow as pa

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            texts = batch.column(2).cast(pa.large_binary()).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([simhash_bytes(t, words, seed) for t in texts], pa.int64())],
                names=["id", "raw", "fp"])

    bounded_batches(docs.sparkSession)
    text = F.col(f"`{text_col}`").cast("string")
    own = docs.select(F.col(f"`{id_col}`").alias("id"), text_hash(text).alias("raw"), text.alias("text"))
    return own.mapInArrow(run, f"id {own.schema['id'].dataType.simpleString()}, raw bigint, fp bigint")


def _segment(fp, seg):
    return F.when(seg == 0, F.shiftrightunsigned(fp, 32)).otherwise(fp.bitwiseAND(F.lit(LOW)))


def variants(fps: DataFrame) -> DataFrame:
    """(key, fp): 64 rows per fingerprint; a key holds segment number, left-out
    bit and the segment with that bit cleared."""
    slot = F.explode(F.sequence(F.lit(0), F.lit(63))).alias("slot")
    one = fps.select("fp", slot)
    seg, bit = F.shiftright("slot", 5), F.col("slot") % 32
    cleared = _segment(F.col("fp"), seg).bitwiseAND(F.bitwise_not(F.expr("shiftleft(1L, slot % 32)")))
    return one.select((F.shiftleft(F.col("slot").cast("long"), 32) + cleared).alias("key"), "fp")


def links(fps: DataFrame, max_bits: int = 2, bucket_cap: int = BUCKET_CAP) -> DataFrame:
    """(a, b) over distinct fingerprints ``fps``: edges whose components are
    those of all pairs at most ``max_bits`` (0 to 2) apart; each edge is such a pair."""
    # 64 rows come of each: spread first, in a number of partitions that AQE leaves alone, and by
    # an expression of the fingerprint, as rows already partitioned by "fp" itself would stay put
    index = variants(fps.repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("fp", F.lit(1))))
    large = stage(index.groupBy("key").count().where(F.col("count") > bucket_cap).select("key"), "large")
    # Spark sizes rows after an explode as those before it, 64 and more times too low, and would
    # broadcast them: here only the staged keys can be, and the exploded rows meet in a sorted merge
    small = index.join(large, "key", "left_anti")
    apart = F.col("x.fp").bitwiseXOR(F.col("y.fp"))
    slot = F.shiftright(F.col("x.key"), 32).cast("int")
    in_segment = _segment(apart, F.shiftright(slot, 5))
    home = (in_segment == F.expr("shiftleft(1L, cast(shiftright(x.key, 32) as int) % 32)")) | ((in_segment == 0) & (slot % 32 == 0))
    near = (small.alias("x").hint("merge").join(small.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x.fp") < F.col("y.fp"))
                                                & (F.bit_count(apart) <= max_bits) & home)
            .select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b")))

    inside = index.join(large, "key", "left_semi").withColumn("slot", F.shiftright("key", 32).cast("int"))
    own = _segment(F.col("fp"), F.shiftright("slot", 5))
    other = _segment(F.col("fp"), 1 - F.shiftright("slot", 5))
    def masks(n: int) -> list[int]:
        pairs = [LOW & ~(1 << i) for i in range(32)] if n == 1 else \
            [LOW & ~(1 << i) & ~(1 << j) for i in range(32) for j in range(i)] if n == 2 else [LOW]
        return pairs if n >= 0 else []
    same = (inside.where(F.col("slot") % 32 == 0)
            .withColumn("mask", F.explode(F.array(*[F.lit(m) for m in masks(max_bits)])))
            .select("slot", own.alias("seg"), "mask", other.bitwiseAND(F.col("mask")).alias("rest"), "fp"))
    cleared = F.col("key").bitwiseAND(F.lit(LOW))
    one_off = (inside.withColumn("mask", F.explode(F.array(*[F.lit(m) for m in masks(max_bits - 1)]).cast("array<bigint>")))
               .select((F.col("slot") + 64).alias("slot"), cleared.alias("seg"), "mask",
                       other.bitwiseAND(F.col("mask")).alias("rest"), "fp"))
    # at most four distinct fingerprints agree in all of these
    group = Window.partitionBy("slot", "seg", "mask", "rest")
    stars = (same.unionByName(one_off).withColumn("least", F.min("fp").over(group))
             .where("fp <> least").select(F.col("least").alias("a"), F.col("fp").alias("b")).distinct())
    return near.unionByName(stars)


def near_duplicates(docs: DataFrame, words: int = 3, max_bits: int = 2, seed: int = 42, bucket_cap: int = BUCKET_CAP,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, raw, fp, component_id) per row of ``docs``."""
    rows = stage(fingerprints(docs, words, seed, id_col, text_col), "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min("id").alias("first"))
    roots = components(links(nodes.select("fp"), max_bits, bucket_cap))
    named = (nodes.join(roots, nodes["fp"] == roots["node"], "left")
             .select("fp", "first", F.coalesce("root", "fp").alias("root")))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    of_fp = named.join(least, "root").select(F.col("fp").alias("__fp"), "component_id")
    # a row for every document: copies make its files small, but not the rows
    return rows.hint("merge").join(of_fp, F.col("fp") == F.col("__fp")).drop("__fp")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of every component: the one whose id names it
    (of several rows with that id, the one of the smallest fingerprint and raw text hash)."""
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, **options)
    kept = (found.where(F.col("id").eqNullSafe(F.col("component_id")))
            .groupBy("component_id", "id", "raw", "fp").agg(F.count(F.lit(1)).alias("copies"))
            .groupBy("component_id", "id").agg(F.min(F.struct("fp", "raw", "copies")).alias("best"))
            .select(F.col("id").alias("__id"), F.col("best.raw").alias("__raw"), F.col("best.copies").alias("__copies")))
    return keep_rows(docs, kept, id_col, text_col)
