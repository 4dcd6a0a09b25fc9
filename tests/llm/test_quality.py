import numpy as np
from conftest import ROWS
from pyspark.sql import functions as F

from docweave.llm import quality

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy_and_clean_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels)
    rows = (quality.score(docs, model).join(labels.withColumnRenamed("doc_id", "id"), "id")
            .where("crc32(cast(cast(id as string) as binary)) % 4 = 2").select("score", "good", "quality").toPandas())
    s, y = rows.score.to_numpy(), rows.quality.to_numpy()
    order = s.argsort().argsort()
    auc = (order[y == 1].sum() - y.sum() * (y.sum() - 1) / 2) / (y.sum() * (1 - y).sum())
    assert len(rows) > 500 and auc > 0.98
    assert rows.good[y == 1].mean() > 0.985 and rows.good[y == 0].mean() < 0.1


def test_views_see_only_their_inputs():
    a = quality.text_features("Some text here.\nSecond line".encode())
    assert a.shape == (quality.SHAPES + quality.PAIRS,) and np.isfinite(a).all()
    assert (quality.meta_features("en", "s", 5) != quality.meta_features(None, "s", 5)).any()
    assert np.isfinite(quality.text_features(None)).all() and np.isfinite(quality.text_features(b" \n\t")).all()
    assert np.isfinite(quality.text_features(b"x" * 2_000_000)).all()
    assert np.isfinite(quality.meta_features(None, None, None)).all() and np.isfinite(quality.meta_features("", "", -5)).all()


def test_pseudo_labels_cross_views():
    rng = np.random.default_rng(0)
    y = np.array([0, 1] * 20, float)
    strong = lambda t: t[:, None] * 2 + rng.normal(scale=0.4, size=(len(t), 3))
    pool_y = rng.integers(0, 2, 400).astype(float)
    weak = rng.normal(size=(40, 3))                       # uninformative on the labelled rows
    m = quality.co_train([strong(y), weak], y, [strong(pool_y), strong(pool_y)], handed=0.15)
    test = rng.integers(0, 2, 300).astype(float)
    second = m.views[1].logit(strong(test))
    assert ((second > 0) == (test > 0.5)).mean() > 0.9   # learnt from the other view's labels


def test_edge_rows(spark, docs, empty):
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 1), (7, None, 0), (11, 1, 1), (5, 0, 0), (99, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels)
    out = quality.score(docs, model).collect()
    assert len(out) == len(ROWS) and all(0 <= r.score <= 1 for r in out)
    kept = quality.drop_poor_documents(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.good for r in out)
    none = labels.where("quality is null")
    assert quality.fit(docs, none) is None and quality.drop_poor_documents(docs, none).count() == len(ROWS)
    assert quality.score(empty, model).count() == 0
    assert quality.fit(empty, labels) is None and quality.drop_poor_documents(empty, labels).count() == 0
    assert quality.fit(docs, labels.where(F.lit(False))) is None


def flipped_views(noise, seed, n=8000):
    """Two views that part the classes almost perfectly, and labels of which a share is flipped."""
    rng = np.random.default_rng(seed)
    true = rng.integers(0, 2, n).astype(float)
    views = [true[:, None] * 4 + rng.normal(scale=0.8, size=(n, 4)) for _ in range(2)]
    return views, true, np.where(rng.random(n) < noise, 1 - true, true)


def test_threshold_with_flipped_labels():
    for noise in (0.0, 0.01, 0.05):
        for seed in range(5):
            views, true, y = flipped_views(noise, seed)
            m = quality.co_train([v[:6500] for v in views], y[:6500], [v[:0] for v in views])
            bins = m.bins([v[6500:] for v in views])
            m.threshold = quality.best_cut(*[np.bincount(bins[y[6500:] == t], minlength=quality.BINS) for t in (0, 1)])
            for cut in (m.threshold, quality.co_train(views, y, [v[:0] for v in views]).threshold):
                kept = m.scores(views)[2] >= cut
                assert kept[true == 1].mean() > 0.99 and kept[true == 0].mean() < 0.02, (noise, seed, cut)


def test_threshold_loses_few_good_rows_where_scores_overlap():
    poor, good = np.zeros((2, quality.BINS), np.int64)
    poor[1000:1900], good[1850:2900] = 10, 10                    # 5 % of the good rows among the highest poor ones
    cut = quality.best_cut(poor, good)
    edge = np.log(cut / (1 - cut)) / quality.REACH * quality.BINS / 2 + quality.BINS / 2
    assert 1840 <= edge <= 1853
    assert quality.best_cut(poor, good * 0) == quality.best_cut(poor * 0, good) == 0.0


def test_threshold_is_chosen_from_all_labelled_rows(spark, monkeypatch):
    """One in twenty labels is flipped; the threshold sees every labelled row past the sample."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    flip = F.xxhash64("doc_id", F.lit("flip")) % 20 == 0
    noisy = labels.withColumn("quality", F.when(flip, 1 - F.col("quality")).otherwise(F.col("quality")))
    seen, inner = [], quality.score_histogram
    monkeypatch.setattr(quality, "SAMPLE", 600)
    monkeypatch.setattr(quality, "score_histogram", lambda *a: seen.append(inner(*a)) or seen[-1])
    model = quality.fit(docs, noisy)
    usable = noisy.where("crc32(cast(cast(doc_id as string) as binary)) % 4 <> 2 and quality in (0, 1)").groupBy("quality").count().collect()
    past = {r["quality"]: max(r["count"] - 600, r["count"] // 5) for r in usable}
    assert past == {0: seen[0][0].sum(), 1: seen[0][1].sum()}
    rows = quality.score(docs, model).join(labels.withColumnRenamed("doc_id", "id"), "id").select("good", "quality").toPandas()
    assert rows.good[rows.quality == 1].mean() > 0.98 and rows.good[rows.quality == 0].mean() < 0.1


def test_all_unlabelled_rows_take_part(spark, monkeypatch):
    """Sums over partitions, added up over several levels, equal those over all rows at
    once; a share of all rows is handed over, however many there are."""
    rng = np.random.default_rng(3)
    wide = lambda t, n: (t[:, None] * 0.5 + rng.normal(size=(len(t), n))).astype(np.float32)
    y, pool_y = rng.integers(0, 2, 300).astype(float), rng.integers(0, 2, 9000).astype(float)
    sizes = (quality.SHAPES + quality.PAIRS, quality.META)
    views, pool = [wide(y, n).astype(float) for n in sizes], [wide(pool_y, n) for n in sizes]
    rows = [(a.tobytes(), b.tobytes()) for a, b in zip(*pool)]
    df = spark.createDataFrame([(bytearray(a), bytearray(b)) for a, b in rows], "text_view binary, meta_view binary").repartition(23)
    monkeypatch.setattr(quality, "FEW", 2)
    monkeypatch.setattr(quality, "FAN_IN", 3)
    seen = []
    inner = quality.given_labels
    monkeypatch.setattr(quality, "given_labels", lambda v, h: seen.append((len(v[0]), h)) or inner(v, h))
    plain = quality.co_train(views, y, [p.astype(float) for p in pool])
    last = max((h for n, h in seen if n == 9000), key=len)
    given, free = inner([p.astype(float) for p in pool], last)
    assert len(last) == quality.ROUNDS and (~free).sum() >= quality.ROUNDS * quality.HANDED * 9000
    monkeypatch.setattr(quality, "given_labels", inner)
    spread = quality.co_train(views, y, quality.spark_pool(df))
    for a, b in zip(plain.views, spread.views):
        assert np.allclose(a.w, b.w, atol=1e-8) and abs(a.b - b.b) < 1e-8


def test_newton_steps_equal_the_plain_fit():
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 400).astype(float)
    x = y[:, None] * 0.7 + rng.normal(size=(400, 5))
    want = quality.fit_logistic(x, y)
    m = quality.Logistic(want.mean, want.scale, np.zeros(5), 0.0)
    for _ in range(25):
        m = quality.newton_step(m, quality.newton_sums(x[:250], y[:250], m) + quality.newton_sums(x[250:], y[250:], m))
    assert np.allclose(m.w, want.w, atol=1e-6) and abs(m.b - want.b) < 1e-6


def test_scores_equal_a_plain_loop(spark, docs):
    """Every row of the edge table, scored one by one with the same model."""
    table, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(table.limit(3000), labels)
    want = []
    for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect():
        views = [quality.text_features(None if r.text is None else r.text.encode()), quality.meta_features(r.lang, r.source, r.n_chars)]
        z = [float(p.w[0] * (np.clip((v - m.mean) / m.scale, -8, 8) @ m.w + m.b - p.mean[0]) / p.scale[0] + p.b) for v, m, p in zip(views, model.views, model.platt)]
        j = model.joint
        z.append(float(sum(np.clip((z[k] - j.mean[k]) / j.scale[k], -8, 8) * j.w[k] for k in range(2)) + j.b))
        s = [1 / (1 + np.exp(-np.clip(v, -40, 40))) for v in z]
        want.append((str(r.doc_id), *[round(v, 4) for v in s], bool(s[2] >= model.threshold)))
    rows = quality.score(docs, model).collect()
    got = [(str(r.id), round(r.text_score, 4), round(r.meta_score, 4), round(r.score, 4), r.good) for r in rows]
    assert sorted(got) == sorted(want)


def test_labelled_id_with_several_texts_is_learnt_once(spark):
    """The same text whatever the order of rows; here of two that differ much."""
    texts = [(1, "plain words of a text"), (1, "!!! ??? 1 2 3"), (3, "other text here"), (4, "x " * 30), (4, "y"), (5, "last of them"), (9, "pool")]
    rows = [(i, t, "en", "s", len(t)) for i, t in texts]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 9)], "doc_id long, quality int, toxic int")
    schema, found = "doc_id long, text string, lang string, source string, n_chars long", []
    for order in (rows, rows[::-1]):
        model = quality.fit(spark.createDataFrame(order, schema).repartition(3), labels)
        found.append(None if model is None else np.concatenate([model.views[0].mean, model.views[0].scale]))
    assert found[0] is not None and (found[0] == found[1]).all()
