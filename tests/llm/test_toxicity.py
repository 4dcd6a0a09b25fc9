import numpy as np
from conftest import ROWS

from docweave.llm import toxicity
from docweave.llm.queries import op1_toxicity

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    rows = op1_toxicity(spark, SF).where("held_out").join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").toPandas()
    s, y = rows.score.to_numpy(), rows.toxic.to_numpy()
    order = s.argsort().argsort()
    auc = (order[y == 1].sum() - y.sum() * (y.sum() - 1) / 2) / (y.sum() * (1 - y).sum())
    assert len(rows) > 500 and auc > 0.95
    assert (rows.predicted == (rows.score >= 0.3)).all()
    assert rows.predicted[y == 1].mean() > 0.8 and rows.predicted[y == 0].mean() < 0.02


def test_convolution_equals_direct_sum():
    rng = np.random.default_rng(1)
    m = toxicity.Model(rng.normal(size=(toxicity.BUCKETS, toxicity.DIM)), [rng.normal(size=(w, toxicity.DIM, toxicity.FILTERS)) for w in toxicity.WIDTHS],
                       rng.normal(size=len(toxicity.WIDTHS) * toxicity.FILTERS), np.zeros(len(toxicity.WIDTHS) * toxicity.FILTERS), 0.0)
    for n in (0, 1, 2, 3, 9):
        b = rng.integers(0, toxicity.BUCKETS, (n, 3))
        x = np.concatenate([m.table[b].sum(1), np.zeros((2, toxicity.DIM))])
        want = np.concatenate([[max(sum(x[t + j] @ f[j, :, k] for j in range(len(f))) for t in range(n)) for k in range(toxicity.FILTERS)]
                               for f in m.filters]) + m.bias if n else np.zeros(len(m.bias))
        assert np.allclose(m.pooled(m.responses(b)), np.maximum(want, 0), atol=1e-4)


def test_small_sample_learns_a_word_and_whole_texts_are_read(spark):
    clean = [f"alpha beta w{i} gamma" for i in range(120)]
    toxic = [f"alpha vile w{i} gamma" for i in range(60)]
    texts = [t.encode() for pair in zip(clean, clean[60:] + toxic) for t in pair]
    y = np.array([float(b"vile" in t) for t in texts])
    m = toxicity.train(texts, y)
    # far beyond one piece of 50,000 words, and on its border
    rows = [(1, "alpha " * 120_000 + "vile"), (2, "alpha " * 120_000), (3, "alpha " * 49_999 + "vile " + "alpha " * 60_000), (4, None), (5, "")]
    got = {r.id: r.score for r in toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), m).collect()}
    assert got[1] >= 0.3 > got[2] and got[3] >= 0.3 and 0 <= got[4] == got[5] <= 1


def test_edge_rows(spark, docs, empty):
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 1), (7, None, None), (11, 1, 1), (5, 0, 0), (99, 1, 0)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    out = toxicity.score(docs, model).collect()
    assert len(out) == len(ROWS) and all(0 <= r.score <= 1 for r in out)
    assert toxicity.score(empty, model).count() == 0
    assert toxicity.fit(docs, labels.where("toxic is null")) is None
    assert {r.score for r in toxicity.score(docs, None).collect()} == {0.0}


def test_an_id_in_many_rows_gives_one_text(spark, monkeypatch):
    rows = [(1, f"text {i} " + "x" * 100) for i in range(300)] + [(1, "text 7 " + "x" * 100)] * 50 + [(2, "other"), (3, None), (3, "third"), (4, None)]
    labels = spark.createDataFrame([(i, 0, i % 2) for i in range(1, 5)], "doc_id long, quality int, toxic int")
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 1000)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    held = {i: __import__("zlib").crc32(str(i).encode()) % 4 == 2 for i in range(1, 5)}
    found = [toxicity._sample(docs, labels, "toxic", h, {1: 10, 0: 10}, "doc_id", "text") for h in (False, True)]
    texts = [t for part, _, _ in found for t in part]
    assert sum(t.startswith(b"text ") for t in texts) == 1 and sum(map(len, texts)) <= 1000
    assert sorted(t for t in texts if not t.startswith(b"text ")) == [b"other", b"third"]
    for h, (part, y, _) in zip((False, True), found):
        assert len(part) == len(y) == sum(held[i] == h for i in (1, 2, 3))


def test_thresholds_do_not_depend_on_the_sample_ratio():
    """Scores of either class overlap; calibration on the table's 1:9 and on a sample forced to 1:2 agree."""
    rng = np.random.default_rng(8)
    logit = np.concatenate([rng.normal(3, 1, 4000), rng.normal(0, 1, 36_000)])
    y = np.repeat([1.0, 0.0], [4000, 36_000])
    pick = np.concatenate([np.arange(4000), 4000 + rng.choice(36_000, 8000, replace=False)])
    weight = np.where(y[pick] == 1, 4000 / 4000, 36_000 / 8000)
    whole = toxicity.best_threshold(logit, y, np.ones(len(y)))
    assert abs(toxicity.best_threshold(logit[pick], y[pick], weight) - whole) < 0.15
    assert toxicity.best_threshold(logit[pick], y[pick], np.ones(len(pick))) < whole - 0.3
    m = [toxicity.Model(np.zeros((1, 1)), [], np.zeros(1), np.zeros(1), 0.0) for _ in range(2)]
    toxicity.calibrate(m[0], logit, y, np.zeros(len(y), int), np.ones(len(y)))
    toxicity.calibrate(m[1], logit[pick], y[pick], np.zeros(len(pick), int), weight)
    assert np.abs(m[0].thresholds - m[1].thresholds).max() < 0.15


def test_scores_equal_a_plain_loop(spark, docs):
    """Every row of the edge table, scored one by one: sums over all places, then the greatest."""
    table, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    m = toxicity.fit(table.limit(2000), labels)
    speech = toxicity._function_words()
    want = []
    for r in docs.select("doc_id", "text").collect():
        words = __import__("re").findall(toxicity.WORD, (r.text or "").encode().lower())
        x = np.concatenate([m.table[list(toxicity.bucket_ids(w))].sum(0)[None] for w in words] + [np.zeros((2, toxicity.DIM))])
        out = []
        for f in m.filters:
            places = np.stack([sum(x[t + j] @ f[j] for j in range(len(f))) for t in range(len(words))]) if words else None
            out.append(np.zeros(toxicity.FILTERS) if places is None else places.max(0))
        pooled = np.maximum(np.concatenate(out) + m.bias, 0) if words else np.zeros(len(m.bias))
        counts = np.bincount([speech[w] for w in words if w in speech], minlength=len(toxicity.FUNCTION_WORDS))
        lang = int(counts.argmax()) if counts.max() else len(toxicity.FUNCTION_WORDS)
        z = m.slope * (pooled @ m.weights + m.offset - m.thresholds[lang]) + np.log(0.3 / 0.7)
        want.append((str(r.doc_id), 1 / (1 + np.exp(-np.clip(z, -40, 40)))))
    got = sorted((str(r.id), r.score) for r in toxicity.score(docs, m).collect())
    assert [a for a, _ in got] == [a for a, _ in sorted(want)]
    assert np.allclose([b for _, b in got], [b for _, b in sorted(want)], atol=1e-3)
