"""Hits against a plain search of every window, for one automaton and for many blocks."""
import hashlib
import random
import re

import pytest
from conftest import SF0001

from docweave.llm import decontaminate as dc


def words(t):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().lower())


def brute_force(text, items, window=10):
    windows = {}
    for name, x in items:
        iw = words(x)
        for win in [iw[i:i + window] for i in range(len(iw) - window + 1)] if len(iw) >= window else [iw] if iw else []:
            windows.setdefault(tuple(win), set()).add("" if name is None else str(name))
    w, hit, found = words(text), set(), set()
    for k in {len(x) for x in windows}:
        for i in range(len(w) - k + 1):
            if names := windows.get(tuple(w[i:i + k])):
                hit.update(range(i, i + k))
                found |= names
    return len(w), len(hit), sorted(found)


def test_automaton_equals_brute_force():
    rng = random.Random(3)
    for _ in range(250):
        letters, window = rng.choice([1, 2, 3, 6]), rng.choice([2, 3, 4, 10])
        items = [(str(i % 7), " ".join(rng.choice("abcdef"[:letters]) for _ in range(rng.randrange(18)))) for i in range(rng.randrange(1, 8))]
        machine = dc.Automaton(window).build([(n, words(x)) for n, x in items if words(x)])
        for _ in range(5):
            t = " ".join(rng.choice("abcdefgh"[:letters + 1]) for _ in range(rng.randrange(50)))
            n, spans, found = machine.read(t.encode())
            assert spans == dc.united(spans) and all(x[1] < y[0] for x, y in zip(spans, spans[1:]))
            assert (n, sum(b - a for a, b in spans), sorted(machine.names[i] for i in found)) == brute_force(t, items, window)


def frames(spark, seed):
    """Items that share a passage, short and empty ones, null ids and texts, repeated rows; texts that quote them."""
    rng = random.Random(seed)
    word = lambda: rng.choice(["été", "Ab", "c3", "d", "e", "f", "g"])
    passage = " ".join(word() for _ in range(25))
    items = [(i, f"{word()} {passage} {word()}, " + " ".join(word() for _ in range(rng.randrange(60)))) for i in range(30)]
    items += [(40, "Short item"), (41, "d"), (42, ""), (43, None), (None, "no id but five words"), (7, "a second text of item seven has words"),
              (40, "Short item")]
    texts = [(k, " ".join(rng.choice([word(), word(), rng.choice(items)[1] or "", "short-ITEM", "NO id, but five words!", "..."]) for _ in range(rng.randrange(14))))
             for k in range(60)]
    texts += [(100, None), (101, ""), (None, passage), (100, passage), (100, passage), (102, (passage + " unseen ") * 3000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("*", "'x' AS id", "1 AS key", "2 AS `a.b`", "3 AS spans").repartition(3)
    return docs, spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS words"), texts, items


@pytest.mark.parametrize("block_words,piece_words", [(200_000, 20_000), (150, 12)])
def test_scan_equals_brute_force(spark, block_words, piece_words):
    docs, bench, texts, items = frames(spark, 5)
    assert (dc.item_blocks(bench, block_words=block_words, piece_words=piece_words)[1] > 1) == (block_words < 1000)
    got = dc.scan(docs, bench, block_words=block_words, piece_words=piece_words).collect()
    rows = [(r.id, r.n_words, sum(s.stop - s.first for s in r.spans), r["items"]) for r in got]
    want = [(k, *brute_force(t, items)) for k, t in texts]
    assert sorted(map(str, rows)) == sorted(map(str, want))


def test_query_on_given_tables(spark):
    from docweave.llm.queries import op13_decontaminate
    docs, bench = (spark.read.parquet(f"{SF0001}/{t}.parquet") for t in ("documents", "benchmark"))
    items = [(r.item_id, r.text) for r in bench.collect()]
    want = []
    for r in docs.select("doc_id", "text").collect():
        n, hit, found = brute_force(r.text, items)
        want.append((r.doc_id, n, hit, len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), hit > 0))
    assert sorted(map(tuple, op13_decontaminate(spark, SF0001).collect())) == sorted(want)


@pytest.mark.parametrize("block_words", [200_000, 150])
def test_decontaminate_cuts_spans_and_drops_documents(spark, block_words):
    docs, bench, texts, items = frames(spark, 6)
    out = dc.decontaminate(docs, bench, max_share=0.6, block_words=block_words, piece_words=12)
    assert out.columns == docs.columns
    got = sorted((str(r.doc_id), str(r.text)) for r in out.collect())
    want = []
    for k, t in texts:
        n, hit, _ = brute_force(t, items)
        if not hit:
            want.append((str(k), str(t)))
        elif hit / n <= 0.6:
            machine = dc.Automaton(10).build([(str(i), words(x)) for i, x in items if words(x)])
            raw = t.encode()
            cuts = dc.byte_spans(raw, machine.read(raw)[1])
            ends, starts = [0, *[b for _, b in cuts]], [*[a for a, _ in cuts], len(raw)]
            want.append((str(k), b"".join(raw[a:b] for a, b in zip(ends, starts)).decode()))
    assert got == sorted(want) and len(want) < len(texts)


def test_empty_tables(spark, empty):
    docs, bench, texts, _ = frames(spark, 7)
    assert dc.scan(empty, bench).collect() == []
    rows = dc.scan(docs, bench.limit(0)).collect()
    assert len(rows) == len(texts) and all(not r.spans and not r["items"] for r in rows)


def test_words_of_long_texts_in_slices():
    raw = ("Été a-b " * 5000).encode()
    assert [w for part in dc.word_lists(raw, 97) for w in part] == words(raw.decode())
