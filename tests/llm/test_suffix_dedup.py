import hashlib
import random

import numpy as np
import pytest
from conftest import ROWS, SF0001

from docweave.llm import suffix_dedup as S


def brute(texts, length):
    """Per text: (bytes, removed, runs, sha256 of the rest)."""
    seen, out = {}, []
    for t in texts:
        for i in range(len(t) - length + 1):
            seen[t[i:i + length]] = seen.get(t[i:i + length], 0) + 1
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        runs = sum(1 for i in range(len(t)) if gone[i] and (not i or not gone[i - 1]))
        out.append((len(t), sum(gone), runs, hashlib.sha256(bytes(c for c, g in zip(t, gone) if not g)).hexdigest()))
    return out


def got(df):
    return sorted(((str(r.id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()))


def made_texts(rng, length):
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6)))
    line = lambda n: " ".join(word() for _ in range(n))
    shared = [line(12) for _ in range(6)] + ["ab" * length, "x" * (2 * length)]
    texts = []
    for _ in range(60):
        parts = [line(rng.randint(0, 15)) for _ in range(3)]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(shared)
            a = rng.randint(0, len(p) // 2)
            parts.insert(rng.randint(0, len(parts)), p[a:rng.randint(a, len(p))])
        texts.append(rng.choice(["", " "]).join(parts))
    return texts + texts[:3] + ["", "ab" * 3 * length, None]


@pytest.mark.parametrize("group", [1, 1024])
@pytest.mark.parametrize("length,gram", [(20, 6), (33, 12)])
def test_equals_brute_force(spark, group, length, gram):
    rng = random.Random(length)
    texts = made_texts(rng, length)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    want = brute([(t or "").encode() for t in texts], length)
    assert got(S.drop_repeats(df, length, gram, group)) == sorted((str(i), *w) for i, w in enumerate(want))


def test_table_and_edge_rows(spark, docs, empty):
    df = spark.read.parquet(f"{SF0001}/documents.parquet")
    rows = df.collect()
    want = brute([r.text.encode() for r in rows], 200)
    assert got(S.drop_repeats(df)) == sorted((str(r.doc_id), *w) for r, w in zip(rows, want))
    want = brute([(r[1] or "").encode() for r in ROWS], 200)
    out = S.drop_repeats(docs)
    assert got(out) == sorted((str(r[0]), *w) for r, w in zip(ROWS, want))
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in out.collect())
    assert S.drop_repeats(empty).count() == 0


def test_long_texts_in_pieces(monkeypatch):
    monkeypatch.setattr(S, "CHUNK", 64)
    rng = random.Random(2)
    raw = np.frombuffer("".join(rng.choice("abc") for _ in range(1000)).encode(), np.uint8)
    names, _ = S.text_anchors(raw, 20, 6)
    found = list(S.text_contexts(raw, names, 20, 6))
    windows = sorted(i for _, _, a, b, times, shift in found for i in range(a, b - 20 + 1 + (times - 1) * shift))
    assert windows == list(range(1000 - 20 + 1))
    for g, lead, a, *_ in found:
        p = S.prefix_hashes(raw[a + lead:a + lead + 6])
        assert int(S._mix(p[6:7]).view(np.int64)[0]) == g


def test_merge_sort_is_a_suffix_sort():
    rng = random.Random(4)
    raw = np.frombuffer("".join(rng.choice("ab") for _ in range(700)).encode() + b"\0" * 50, np.uint8)
    s = S.Suffixes(raw, 50)
    items = np.array(rng.sample(range(700), 300))
    size = np.array([1, 7, 64, 100, 128])
    head = np.concatenate([[0], np.cumsum(size)[:-1]])
    out = s.sort(items, np.repeat(head, size), np.repeat(size, size))
    for a, n in zip(head, size):
        assert [raw[i:i + 50].tobytes() for i in out[a:a + n]] == sorted(raw[i:i + 50].tobytes() for i in items[a:a + n])
        assert sorted(out[a:a + n]) == sorted(items[a:a + n])


def test_hash_collisions_are_caught(monkeypatch):
    """With all hashes equal every comparison claims equality; the result stays right."""
    monkeypatch.setattr(S.Suffixes, "_hash", lambda self, i, n: np.zeros(len(i), np.uint64))
    texts = [b"0123456789abcdefghij", b"0123456789abcdefghiX", b"0123456789abcdefghij", b"zzzz456789abcdefghij"]
    masks = S.repeated_windows(np.zeros(4, np.int64), np.array([5, 5, 5, 5]), np.ones(4, np.int64), texts, 12)
    assert [m.tolist() for m in masks] == [[True] * 9, [True] * 8 + [False], [True] * 9, [False] * 4 + [True] * 5]


@pytest.mark.parametrize("piece,n", [("a", 3_000_000), ("=-", 1_000_000), ("ab c", 400_000)])
def test_long_periodic_text(spark, piece, n):
    """Some MB of a short period between unique bytes: all of it goes, and the worker
    holds a few contexts, not one per period."""
    rng = random.Random(n)
    head, tail = ("".join(rng.choice("uvwxyz") for _ in range(700)) for _ in range(2))
    text = head + piece * n + tail
    found = list(S.text_contexts(np.frombuffer(text.encode(), np.uint8), S.text_anchors(np.frombuffer(text.encode(), np.uint8), 200, S.GRAM)[0], 200, S.GRAM))
    assert sum(b - a for _, _, a, b, _, _ in found) < 50_000 and sum(times for *_, times, _ in found) > n // 4
    df = spark.createDataFrame([(1, text), (2, "other " + head[:150])], "doc_id long, text string")
    rest = hashlib.sha256((head + tail).encode()).hexdigest()
    assert got(S.drop_repeats(df))[0] == ("1", len(text), len(piece) * n, 1, rest)


@pytest.mark.parametrize("group", [1, 1024])
def test_periodic_texts_meet_their_copies(spark, group):
    """Periodic passages that other documents share in part, some shorter than two windows."""
    rng = random.Random(group)
    texts = []
    for _ in range(40):
        p = rng.choice(["a", "ab", "xyz", "=-=="])
        body = (p * 80)[rng.randrange(4):rng.randrange(15, 90)]
        texts.append("".join(rng.choice("mnopq") for _ in range(rng.randrange(30))) + body + rng.choice(["", "!", "tail of it"]))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    want = brute([t.encode() for t in texts], 20)
    assert got(S.drop_repeats(df, 20, 6, group)) == sorted((str(i), *w) for i, w in enumerate(want))
