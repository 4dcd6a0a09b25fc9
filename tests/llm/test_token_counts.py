import random

import numpy as np
import pytest
from conftest import ROWS, SF0001

from docweave.llm import token_counts as T

public = pytest.importorskip("public_tokenizers")


def path():
    return public.path("byte_bpe_50k.tiktoken")


def brute(text, spans, rule):
    """Walks the tokens one by one; spans in characters."""
    enc, _ = T._encoding(path(), public.PATTERN)
    counts, crossing, at = [0.0] * len(spans), [0] * len(spans), 0
    raw = text.encode()
    owner = [i for i, c in enumerate(text) for _ in c.encode()]     # byte -> character
    for t in enc.encode_ordinary(text):
        piece = enc.decode_single_token_bytes(t)
        assert raw[at:at + len(piece)] == piece
        chars = set(owner[at:at + len(piece)])
        at += len(piece)
        over = [len(chars & set(range(a, b))) for a, b in spans]
        hit = [k for k, o in enumerate(over) if o]
        if not hit:
            before = [k for k, (a, b) in enumerate(spans) if b > a and b <= min(chars)]
            full = [k for k, (a, b) in enumerate(spans) if b > a]
            counts[before[-1] if before else full[0] if full else 0] += 1
            continue
        if len(hit) > 1:
            for k in hit:
                crossing[k] += 1
        if rule == "share":
            for k in hit:
                counts[k] += over[k] / sum(over)
        else:
            counts[hit[0] if rule == "first" else max(hit, key=lambda k: (over[k], -k))] += 1
    return counts, crossing


def line_spans(text):
    spans, at = [], 0
    for line in text.split("\n"):
        spans.append((at, min(len(text), at + len(line) + 1)))
        at += len(line) + 1
    if len(spans) > 1 and spans[-1][0] == len(text):
        spans.pop()
    return spans


@pytest.mark.parametrize("rule", T.RULES)
def test_lines_equal_brute_force(spark, docs, rule):
    rng = random.Random(5)
    bits = ["a", " b", "\n", "\n\n", "\n\n\n", "  ", "é", "日本", "😀", "don't", "\r\n", "\t", "x" * 30, "<|endoftext|>", "́"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))) for i in range(150)]
    rows += [(1000 + i, r[1]) for i, r in enumerate(ROWS) if len(r[1] or "") < 1000]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {}
    for r in T.attribute(df, path(), public.PATTERN, rule).collect():
        got.setdefault(r.id, []).append((r.section, r.start, r.end, r.tokens, r.crossing))
    assert len(got) == len(rows)
    for i, text in rows:
        spans = line_spans(text or "")
        count, crossing = brute(text or "", spans, rule)
        have = sorted(got[i])
        assert [(s, a, b) for s, a, b, _, _ in have] == [(k, a, b) for k, (a, b) in enumerate(spans)], repr(text)
        assert np.allclose([h[3] for h in have], count) and [h[4] for h in have] == crossing, repr(text)


def test_fields_with_gaps(spark):
    rows = [(1, "Title here", "body  ", None), (2, "", "only body", "x"), (3, None, None, None), (4, "a", "b", "c")]
    df = spark.createDataFrame(rows, "id long, title string, text string, tags string")
    out = T.attribute(df, path(), public.PATTERN, id_col="id", fields=["title", "text", "tags"], separator="\n\n").collect()
    for i, *parts in rows:
        parts = [p or "" for p in parts]
        text, spans, at = "\n\n".join(parts), [], 0
        for p in parts:
            spans.append((at, at + len(p)))
            at += len(p) + 2
        count, crossing = brute(text, spans, "largest")
        have = sorted((r.section, r.start, r.end, r.tokens, r.crossing, r.name) for r in out if r.id == i)
        assert [h[1:5] for h in have] == [(a, b, c, x) for (a, b), c, x in zip(spans, count, crossing)]
        assert [h[5] for h in have] == ["title", "text", "tags"]


def test_counts_add_up_on_the_table(spark, docs, empty):
    enc, _ = T._encoding(path(), public.PATTERN)
    df = spark.read.parquet(f"{SF0001}/documents.parquet")
    got = {}
    for r in T.attribute(df, path(), public.PATTERN).collect():
        got[r.id] = got.get(r.id, 0) + r.tokens
    assert got == {r.doc_id: len(enc.encode_ordinary(r.text)) for r in df.collect()}
    assert T.attribute(docs, path(), public.PATTERN).where("section = 0").count() == len(ROWS)
    assert T.attribute(empty, path(), public.PATTERN).count() == 0
