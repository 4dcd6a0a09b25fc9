import random

import pytest
import xxhash
from conftest import ROWS, SF0001
from pyspark.sql import functions as F

from docweave.llm import simhash


def fingerprint(text, k=3):
    w = [x for x in (text or "").encode().lower().split()]
    if not w:
        return 0
    grams = [b" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))]
    h = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps):
    """fps: (id, fp) list; smallest id reachable over pairs at most 2 bits apart."""
    root = list(range(len(fps)))
    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i][1] ^ fps[j][1]).bit_count() <= 2:
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(fps):
        r = find(i)
        least[r] = doc if least.get(r) is None else least[r] if doc is None else min(doc, least[r])
    return sorted((str(doc), least[find(i)]) for i, (doc, _) in enumerate(fps))


def test_fingerprint_matches_definition_and_native_hash(spark):
    from pyspark.sql import functions as F
    for t in ["", None, "a", "a B", "The quick brown fox jumps", "é à ü é à ü", "w " * 50, ROWS[8][1], ROWS[12][1]]:
        got = simhash.simhash_bytes(None if t is None else t.encode(), 3, 42)
        assert got & (2**64 - 1) == fingerprint(t)
    h = spark.range(1).select(F.xxhash64(F.lit("one two three")).alias("h")).first().h
    assert h & (2**64 - 1) == xxhash.xxh64(b"one two three", seed=42).intdigest()


def test_rows_equal_brute_force(spark, docs):
    for df in (spark.read.parquet(f"{SF0001}/documents.parquet"), docs):
        got = simhash.near_duplicates(df).collect()
        rows = [(r.doc_id, fingerprint(r.text)) for r in df.select("doc_id", "text").collect()]
        assert sorted((str(r.id), r.fp & (2**64 - 1)) for r in got) == sorted((str(a), b) for a, b in rows)
        assert sorted((str(r.id), r.component_id) for r in got) == components(rows)


@pytest.mark.parametrize("cap", [2, 8, 10_000])
def test_all_links_with_any_bucket_cap(spark, cap):
    rng = random.Random(cap)
    base = [rng.getrandbits(64) for _ in range(12)]
    fps = {0, 1, 3, 7, 2**63, 2**64 - 1}
    for b in base:
        x = b
        for _ in range(20):
            x ^= sum(1 << i for i in rng.sample(range(64), rng.choice([1, 2, 3])))
            fps.add(x)
    fps = sorted(fps)
    signed = [(x - 2**64 if x >= 2**63 else x,) for x in fps]
    edges = simhash.links(spark.createDataFrame(signed, "fp long"), 2, cap).collect()
    want = {(fps[i], fps[j]) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2}
    got = {tuple(sorted((e.a & (2**64 - 1), e.b & (2**64 - 1)), reverse=True)) for e in edges}
    assert got <= want
    if cap == 10_000:
        assert got == want
    def parts(pairs):
        root = {x: x for x in fps}
        def find(x):
            while root[x] != x:
                x = root[x]
            return x
        for a, b in pairs:
            root[max(find(a), find(b))] = min(find(a), find(b))
        return [find(x) for x in fps]
    assert parts(got) == parts(want)


def test_one_of_each_component_stays(docs, empty):
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    want = components([(r[0], fingerprint(r[1])) for r in ROWS])
    assert {r.doc_id for r in kept.collect()} == {c for _, c in want} and kept.count() == len({c for _, c in want})
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.drop_near_duplicates(empty).count() == 0


def test_fingerprints_are_dealt_out_before_their_variants(spark):
    """The exchange survives planning though the rows are already grouped by fingerprint."""
    fps = spark.range(1000).select((F.col("id") * 7919).alias("fp")).groupBy("fp").agg(F.count(F.lit(1)).alias("n")).select("fp")
    plan = simhash.links(fps)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(xxhash64(fp" in plan
