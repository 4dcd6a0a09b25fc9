"""Runs against a quadratic search, planted periods against a plain loop, long periodic texts."""
import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from docweave.llm import periodic_runs as pr


def brute_force(words, min_words=24, min_periods=3):
    out, n = {}, len(words)
    for q in range(1, n // min_periods + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(min_words, min_periods * q):
                out.setdefault((i, j - i + q), q)
            i = j
    return sorted(((a, n, q) for (a, n), q in out.items()), key=lambda r: (r[0], r[2]))


def texts(rng):
    kind, n = rng.randrange(6), rng.choice([0, 1, 5, 23, 24, 30, 60, 150, 300])
    if kind == 0:
        return [rng.choice("ab") for _ in range(n)]
    if kind == 1:
        return ["a"] * n
    if kind == 2:                                            # a period with a few flaws
        w = ([rng.choice("abc") for _ in range(rng.randrange(1, 12))] * n)[:n]
        for _ in range(rng.randrange(3)):
            if w:
                w[rng.randrange(len(w))] = "z"
        return w
    if kind == 3:                                            # runs of runs
        w = ["a"]
        while len(w) < n:
            w = w * rng.choice([2, 3, 4]) + [rng.choice("ab")]
        return w[:n]
    if kind == 4:                                            # Fibonacci words
        x, y = ["a"], ["a", "b"]
        while len(y) < n:
            x, y = y, y + x
        return y[:n]
    return [str(rng.randrange(50)) for _ in range(n)]


def joined(batch):
    sizes = np.array([len(b) for b in batch], np.int64)
    number, line = {}, [10**6]
    for k, b in enumerate(batch):
        line += [number.setdefault(x, len(number)) for x in b] + [10**6 + 1 + k]
    return np.array(line), np.cumsum(sizes + 1) - sizes, sizes


@pytest.mark.parametrize("min_words,min_periods,at_once,long", [(24, 3, 1 << 20, 4096), (6, 2, 50, 4096), (4, 3, 7, 4), (24, 3, 13, 24)])
def test_runs_equal_brute_force(monkeypatch, min_words, min_periods, at_once, long):
    """Any size of the steps, and with runs known early that spare later candidates."""
    known = pr.long_runs
    monkeypatch.setattr(pr, "long_runs", lambda found, starts: known(found, starts, long))
    rng = random.Random(at_once)
    for _ in range(80):
        batch = [texts(rng) for _ in range(rng.randrange(1, 6))]
        got = pr.find_runs(*joined(batch), min_words, min_periods, at_once)
        assert [tuple(r) for r in got.tolist()] == [(k, *r) for k, b in enumerate(batch) for r in brute_force(b, min_words, min_periods)]


def test_extensions_equal_a_loop():
    rng = random.Random(7)
    for _ in range(60):
        line, _, _ = joined([texts(rng) for _ in range(3)])
        rounds = pr.grammar(line, 1)
        n = len(line)
        pairs = [(rng.randrange(n), rng.randrange(n)) for _ in range(40)]
        i, j = np.array([p for p in pairs if p[0] != p[1]]).T
        plain = lambda a, b, x: next(k for k in range(n) if x[a + k] != x[b + k])
        assert pr.extensions(rounds, i, j).tolist() == [plain(a, b, line) for a, b in zip(i, j)]
        back = line[::-1]
        assert pr.extensions(pr.mirrored(rounds), i, j).tolist() == [plain(a, b, back) for a, b in zip(i, j)]


def expected(text, plant_key=None):
    w = (text or "").encode().split()
    h = None if plant_key is None else zlib.crc32(str(plant_key).encode())
    if h is not None and h % 10 == 0 and w:
        n, g = len(w), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_force(w)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
    listed = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
    return (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_query_rows_equal_brute_force(spark, docs):
    from pyspark.sql import functions as F

    rng = random.Random(11)
    made = [(k, " ".join(texts(rng)) if rng.random() > 0.1 else None) for k in range(400)] + [(None, "a " * 30), (5, "x\x0by " * 40), (5, "x\x0by " * 40)]
    frame = spark.createDataFrame(made, "doc_id long, text string").withColumn("id", F.lit("clash")).withColumn("start", F.lit(1))
    for df in (frame, docs):
        planted = df.withColumn("text", pr.planted_text(F.col("text"), F.col("doc_id")))
        got = pr.periodic_runs(planted).collect()
        want = [(r.doc_id, *expected(r.text, r.doc_id)) for r in df.select("doc_id", "text").collect()]
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_runs_and_collapsed_text(spark):
    df = spark.createDataFrame([(1, "so " + "a b c " * 10 + "end")], "doc_id long, text string")
    row = pr.periodic_runs(df, with_text=True).first()
    assert row.collapsed == "so a b c end" and [tuple(r) for r in row.runs] == [(1, 30, 3)]


def test_empty_table(spark, empty):
    assert pr.periodic_runs(empty).collect() == []


@pytest.mark.parametrize("piece,n,q", [("a ", 1_000_000, 1), ("=- -= ", 500_000, 2), ("x y z " * 9 + "w ", 30_000, 28)])
def test_long_periodic_text(piece, n, q):
    got = pr.describe([(piece * n).encode()], 24, 3, False)
    words = len(piece.split()) * n
    assert (got["start"], got["length"], got["period"]) == ([0], [words], [q])
