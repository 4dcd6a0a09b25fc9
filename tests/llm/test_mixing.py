import re

import pytest
from conftest import ROWS, SF0001

from docweave.llm import mixing


def words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def waterfill(sizes, cap=3):
    """Targets by repeated resharing."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: i % 3 + 1 for i, s in enumerate(order)}
    fixed, total = {}, sum(sizes.values())
    while True:
        rest = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        now = {s: left * w[s] / sum(w[x] for x in rest) for s in rest}
        over = [s for s in rest if now[s] > cap * sizes[s] + 1e-9]
        if not over:
            return fixed | now
        fixed |= {s: cap * sizes[s] for s in over}


def check(rows, docs):
    got = [r for r in docs.collect()]
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + words(r[1])
    want = waterfill(sizes)
    assert len(got) == len(rows)
    taken = {}
    for r in got:
        assert r.size >= 0 and 0 <= r.taken <= 3 * r.size
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        taken[r.source] = taken.get(r.source, 0) + r.taken
    return sizes, want, taken


def test_targets_and_taken(spark):
    df = spark.read.parquet(f"{SF0001}/documents.parquet")
    rows = [tuple(r) for r in df.collect()]
    documents, pieces = mixing.mix(df)
    sizes, want, taken = check(rows, documents)
    block = max(1, min(4096, sum(sizes.values()) // 65536))
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 20 * block
    again, _ = mixing.mix(df.repartition(5))
    key = lambda r: (r.id, r.taken)
    assert sorted(map(key, again.collect())) == sorted(map(key, documents.collect()))
    p = pieces.collect()
    assert sum(r.length for r in p) == sum(taken.values())
    # any prefix of the mix is close to the target shares
    half = sorted({(r.slot, r.src_no) for r in p})
    half = half[: len(half) // 2]
    share = {}
    for _, s in half:
        share[s] = share.get(s, 0) + 1 / len(half)
    order = sorted(sizes, key=lambda s: s.encode())
    assert all(abs(share.get(i, 0) - want[s] / sum(want.values())) < 0.005 for i, s in enumerate(order))


def test_edge_rows(docs):
    documents, pieces = mixing.mix(docs)
    check(ROWS, documents)
    assert pieces.where("length <= 0").count() == 0
    out = mixing.repeat_documents(docs)
    assert out.columns == docs.columns and out.where("text is null").count() == 0


def test_empty_table(empty, spark):
    documents, pieces = mixing.mix(empty)
    assert documents.count() == 0 and pieces.count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    documents, _ = mixing.mix(blank)
    assert [(r.size, r.target, r.taken) for r in documents.collect()] == [(0, 0.0, 0)] * 2
