"""Quality classifier by co-training of two views.

The text view sees the content: about 20 shape statistics (word and line
lengths, symbol, digit and capital shares, repeated words, pairs and lines,
function words) and hashed byte-pair frequencies. The metadata view sees only
the page's columns: language, source and stored length. Both are logistic
models trained in numpy on the driver.

Rounds: each view is fitted on the labelled rows and the pseudo-labels it was
given, scores *all* unlabelled rows, and hands its most confident rows of either
class to the other view: the ``HANDED`` share of all unlabelled rows, cut at a
quantile of a score histogram of each class's end, if their probability is beyond
``SURE``. Rows handed over leave the pool. Which rows those are follows from the
models and cuts of the rounds so far, so workers find it again from a row's
vectors; no list of rows is kept. A fit is Newton's method: the sums over
pseudo-labelled rows (gradient, curvature, counts by class) are added up in Spark,
partition sums by partition sums, however many rows there are. After the last
round each view is calibrated (Platt) on labelled rows that no fit saw, and a last
logistic layer over the two calibrated views, fitted on the same rows, gives
the score of every document.

Bounds of what reaches the driver: ``SAMPLE`` labelled rows of each class as
feature vectors (not texts), and ``FEW`` rows of sums. Pseudo-labels, counts and
scores cover whole texts and all rows. Of several rows with a labelled id the one
with the smallest hash of its text is learnt from.

A document is rejected when its score is below a threshold. The threshold is
chosen from a histogram, by class, of the scores of all labelled rows that no
fit saw (counted in Spark; at least a fifth of each class, and all rows past
``SAMPLE``): the cut with the best balanced accuracy among those that lose at
most ``LOSS`` of the good rows. Flipped labels are no losses: the share of rows
labelled good among the scores that poor rows have is taken as label noise, up
to ``NOISE``, and subtracted (see ``best_cut``). The views' vectors are computed
once, in the shared folder. Very long texts are read whole, in their row's task.

Defined results: null text is empty text; null language, source or length are
values of their own; rows of held-out ids (crc32(id) mod 4 = 2) and null labels
are never learnt from; without rows of both classes every score is 1 and
nothing is rejected; repeated rows get equal scores; an empty table gives no
rows. Columns other than the five named ones are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.common import bounded_batches, stage, text_hash
from docweave.llm.toxicity import FUNCTION_WORDS, is_held_out

#: bound of the sample: labelled rows of each class
SAMPLE = 4000
#: rounds, share of the unlabelled rows that a view hands over in each, and the least probability of those
ROUNDS, HANDED, SURE = 4, 0.05, 0.97
#: Newton steps of a refit; partition sums that reach the driver at most, and that one task adds up
STEPS, FEW, FAN_IN = 3, 8, 64
#: good rows the threshold may lose, and most rows labelled good that may count as flipped (5 % and the error of that count)
LOSS, NOISE = 0.002, 0.1
#: score histogram: bins of the joint logit from -REACH to REACH
BINS, REACH = 4000, 20.0
SHAPES, PAIRS, META = 20, 256, 72


def text_features(raw: bytes | None) -> np.ndarray:
    """The text view of one whole text (float32, SHAPES + PAIRS)."""
    raw = raw or b""
    out = np.zeros(SHAPES + PAIRS, np.float32)
    out[0] = 1.0 if not raw.strip() else 0.0
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    if not words:
        return out
    n, distinct = len(words), set(words)
    b = np.frombuffer(raw, np.uint8)
    kinds = _KIND[b]
    upper, lower, digit, space, symbol, other = (np.bincount(kinds, minlength=6) / len(b)).tolist()
    lens = np.fromiter(map(len, words), np.int64, n)
    pairs = len(set(zip(words, words[1:]))) / max(1, n - 1)
    same_next = sum(map(bytes.__eq__, words, words[1:])) / max(1, n - 1)
    low = [w.strip(b".,;:!?").lower() for w in distinct]
    speech = sum(w in _SPEECH for w in low) / len(distinct)
    ends = _KIND[np.frombuffer(b"".join([w[-1:] for w in words]), np.uint8)]
    out[1:SHAPES] = (
        np.log1p(n) / 10, np.log1p(len(lines)) / 8, len(distinct) / n, pairs, same_next, len(set(lines)) / len(lines),
        lens.mean() / 10, min(lens.max(), 100) / 100, (lens == 1).mean(), upper * 2, lower, digit * 5, space * 3, symbol * 5, other,
        (ends == 4).mean(), speech, np.log1p(n / len(lines)) / 6, len(distinct) ** 0.5 / n ** 0.5)
    code = (_FOLD[b[:-1]].astype(np.int64) * 31 + _FOLD[b[1:]]) * 0x9E37 % 0x10001 % PAIRS
    hist = np.bincount(code, minlength=PAIRS)
    out[SHAPES:] = np.sqrt(hist / max(1, hist.sum()))
    return out


def _kinds() -> np.ndarray:
    k = np.full(256, 4, np.uint8)                      # other ASCII: symbols
    k[65:91], k[97:123], k[48:58], k[128:] = 0, 1, 2, 5
    k[[32, 9, 10, 11, 12, 13]] = 3
    return k


_KIND = _kinds()
#: letters of either case and all non-ASCII bytes fold together: pairs show shape, not spelling
_FOLD = np.where((_KIND == 0), 65, np.where((_KIND == 1), 97, np.where(_KIND == 5, 128, np.arange(256)))).astype(np.uint8)
_SPEECH = {w.encode() for words in FUNCTION_WORDS.values() for w in words.split()}


def meta_features(lang: str | None, source: str | None, n_chars: int | None) -> np.ndarray:
    """The metadata view (float32, META): hashed language and source, length bins."""
    import zlib

    out = np.zeros(META, np.float32)
    out[zlib.crc32(f"l:{lang}".encode()) % 16] = 1
    out[16 + zlib.crc32(f"s:{source}".encode()) % 40] = 1
    if n_chars is None:
        out[56] = 1
    else:
        size = np.log2(1 + max(0, n_chars))
        out[57 + min(13, int(size))] = 1
        out[71] = size / 20
    return out


def features(docs: DataFrame, cols: tuple, carry: bool = False) -> DataFrame:
    """(id, t, text_view, meta_view) per row, and with ``carry`` all columns of
    ``docs`` as c0, c1, ...: float32 vectors as bytes, t a hash of the text."""
    import pyarrow as pa

    own = _columns(docs, cols, [F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(docs.columns)] if carry else [])
    names = [c for c in own.columns if c[0] == "c"]

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary()).to_pylist()
            meta = zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(5), pa.array([text_features(t).tobytes() for t in texts], pa.binary()),
                 pa.array([meta_features(*m).tobytes() for m in meta], pa.binary()), *[batch.column(6 + k) for k in range(len(names))]],
                names=["id", "t", "text_view", "meta_view", *names])

    bounded_batches(docs.sparkSession)
    kinds = "".join(f", {c} {own.schema[c].dataType.simpleString()}" for c in names)
    return own.mapInArrow(run, f"id {own.schema['id'].dataType.simpleString()}, t bigint, text_view binary, meta_view binary{kinds}")


def _columns(docs: DataFrame, cols: tuple, more: list = ()) -> DataFrame:
    i, t, lang, source, n = (F.col(f"`{c}`") for c in cols)
    return docs.select(i.alias("id"), t.cast("string").alias("text"), lang.cast("string").alias("lang"),
                       source.cast("string").alias("source"), n.cast("long").alias("n_chars"), text_hash(t.cast("string")).alias("t"), *more)


@dataclass
class Logistic:
    mean: np.ndarray
    scale: np.ndarray
    w: np.ndarray
    b: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.w + self.b


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 25) -> Logistic:
    """Ridge logistic regression by Newton steps; classes weigh the same."""
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-3)
    z = np.concatenate([np.clip((x - mean) / scale, -8, 8), np.ones((len(x), 1))], axis=1)
    share = np.where(y > 0.5, 0.5 / max(1, (y > 0.5).sum()), 0.5 / max(1, (y <= 0.5).sum())) * len(y)
    w, penalty = np.zeros(z.shape[1]), np.full(z.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (share * (p - y)) + penalty * w
        hess = (z * (share * np.maximum(p * (1 - p), 1e-4))[:, None]).T @ z + np.diag(penalty)
        move = np.linalg.solve(hess, grad)
        w -= move * min(1.0, 5.0 / max(1e-9, np.abs(move).max()))
        if np.abs(move).max() < 1e-5:
            break
    return Logistic(mean, scale, w[:-1], float(w[-1]))


@dataclass
class Model:
    views: list[Logistic]
    platt: list[Logistic]
    joint: Logistic
    threshold: float

    def scores(self, views: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        cal = self.calibrated(views)
        return (*[_sigmoid(c) for c in cal], _sigmoid(self.joint.logit(np.stack(cal, 1))))

    def calibrated(self, views: list[np.ndarray]) -> list[np.ndarray]:
        return [p.logit(v.logit(x)[:, None]) for v, p, x in zip(self.views, self.platt, views)]

    def bins(self, views: list[np.ndarray]) -> np.ndarray:
        return bins_of(self.joint.logit(np.stack(self.calibrated(views), 1)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def bins_of(logit: np.ndarray) -> np.ndarray:
    return np.clip(np.floor((logit + REACH) * (BINS / (2 * REACH))), 0, BINS - 1).astype(np.int32)


def best_cut(poor: np.ndarray, good: np.ndarray) -> float:
    """The score threshold from the rows of either label per bin. With flipped
    labels, rows labelled good also have the scores of poor rows: a constant
    share of those at every cut. The least such share over cuts that reject half
    of the poor rows, each raised by three standard errors of its count, bounds
    it (at most ``NOISE``); what a cut rejects beyond it is loss. Of cuts that
    lose at most ``LOSS`` and reject no score over 0.5, the one with the best
    balanced accuracy, which flipped labels do not move; the middle one of equal
    cuts."""
    if not poor.sum() or not good.sum():
        return 0.0
    b, g = (np.concatenate([[0], np.cumsum(c)]) / c.sum() for c in (poor, good))      # rejected by a cut at each edge
    half = b >= 0.5
    noise = min(NOISE, float(((np.sqrt(g[half] * good.sum()) + 1.5) ** 2 / b[half]).min() / good.sum()))
    edge = np.linspace(-REACH, REACH, BINS + 1)
    allowed = (g - noise * b <= LOSS) & (edge <= 0)
    gain = np.where(allowed, b - g, -1.0)
    first = int(gain.argmax())
    other = np.flatnonzero(gain[first:] < gain[first] - 1e-12)
    last = first + int(other[0] if len(other) else len(gain) - first) - 1
    return float(_sigmoid(edge[(first + last) // 2]))


# --- co-training ---------------------------------------------------------------------

#: a round so far: the two views' models, and for each view the logits at most (poor) and at least (good) which its rows are handed over
Handing = tuple[list[Logistic], list[tuple[float, float]]]


def given_labels(views: list[np.ndarray], history: list[Handing]) -> tuple[list[np.ndarray], np.ndarray]:
    """([labels that the text view, the metadata view was given: 0, 1 or -1], rows still free)."""
    free = np.ones(len(views[0]), bool)
    given = [np.full(len(free), -1, np.int8) for _ in views]
    for models, cuts in history:
        for k, (m, (low, high)) in enumerate(zip(models, cuts)):
            z = m.logit(views[k])
            good, poor = free & (z >= high), free & (z <= low)
            given[1 - k][good], given[1 - k][poor] = 1, 0
            free &= ~(good | poor)
    return given, free


def newton_sums(x: np.ndarray, y: np.ndarray, m: Logistic) -> np.ndarray:
    """For each class: its rows, gradient and upper curvature at ``m``, in one line."""
    z = np.concatenate([np.clip((x - m.mean) / m.scale, -8, 8), np.ones((len(x), 1))], axis=1)
    p, upper = _sigmoid(m.logit(x)), np.triu_indices(z.shape[1])
    out = []
    for c in (0, 1):
        own = y == c
        a, q = z[own], p[own]
        out += [[own.sum()], a.T @ (q - c), ((a * np.maximum(q * (1 - q), 1e-4)[:, None]).T @ a)[upper]]
    return np.concatenate(out)


def newton_step(m: Logistic, sums: np.ndarray, ridge: float = 1.0) -> Logistic:
    """One step from the sums of all rows; classes weigh the same."""
    d = len(m.w) + 1
    size, upper = 1 + d + d * (d + 1) // 2, np.triu_indices(d)
    w, penalty = np.append(m.w, m.b), np.full(d, ridge)
    penalty[-1] = 1e-6
    parts = sums.reshape(2, size)
    total, grad, curve = parts[:, 0].sum(), penalty * w, np.diag(penalty)
    for part in parts:
        share = total * 0.5 / max(1.0, part[0])
        half = np.zeros((d, d))
        half[upper] = part[1 + d:]
        grad = grad + share * part[1:1 + d]
        curve = curve + share * (half + half.T - np.diag(np.diag(half)))
    move = np.linalg.solve(curve, grad)
    w = w - move * min(1.0, 5.0 / max(1e-9, np.abs(move).max()))
    return Logistic(m.mean, m.scale, w[:-1], float(w[-1]))


def pool_sums(views: list[np.ndarray], history: list[Handing], models: list[Logistic], task: str) -> np.ndarray:
    """What a part of the unlabelled rows adds: "rows" the histogram of both
    views' logits over free rows, "sums" the Newton sums of both views."""
    given, free = given_labels(views, history)
    if task == "rows":
        return np.concatenate([np.bincount(bins_of(m.logit(x[free])), minlength=BINS) for m, x in zip(models, views)]).astype(float)
    return np.concatenate([newton_sums(x[g >= 0], g[g >= 0], m) for x, g, m in zip(views, given, models)])


def handing_cuts(rows: np.ndarray, share: float, handed: float) -> list[tuple[float, float]]:
    """For each view the cuts that hand over ``handed`` of all rows, ``share`` of
    those as good: whole bins from either end, as far as they are sure."""
    edge, sure = np.linspace(-REACH, REACH, BINS + 1), np.log(SURE / (1 - SURE))
    cuts = []
    for counts in rows.reshape(2, BINS):
        low = int(np.searchsorted(np.cumsum(counts), max(1.0, handed * (1 - share)))) + 1
        high = BINS - 1 - int(np.searchsorted(np.cumsum(counts[::-1]), max(1.0, handed * share)))
        cuts.append((min(-sure, edge[min(low, BINS)]), max(sure, edge[max(high, 0)])))
    return cuts


def co_train(views: list[np.ndarray], y: np.ndarray, pool, rounds: int = ROUNDS, handed: float = HANDED) -> Model:
    """views: [text rows, metadata rows] of the labelled sample, of which every
    fifth row only calibrates. pool(history, models, task): ``pool_sums`` over all
    unlabelled rows; or the rows themselves."""
    rows_of = pool if callable(pool) else lambda history, models, task: pool_sums(pool, history, models, task)
    held = np.arange(len(y)) % 5 == 0
    if len({*y[held]}) < 2 or len({*y[~held]}) < 2:
        held[:] = False
    fit_x, fit_y, share = [v[~held] for v in views], y[~held], y[~held].mean()
    models, history, total = [fit_logistic(x, fit_y) for x in fit_x], [], None
    for _ in range(rounds):
        counts = rows_of(history, models, "rows")
        total = counts[:BINS].sum() if total is None else total
        if not counts.any():
            break
        history.append((models, handing_cuts(counts, share, handed * total)))
        # from zero, where Newton's method neither stalls nor overshoots
        models = [Logistic(m.mean, m.scale, np.zeros(len(m.w)), 0.0) for m in models]
        for _ in range(STEPS):
            sums = rows_of(history, models, "sums")
            stop = len(newton_sums(fit_x[0][:0], fit_y[:0], models[0]))
            models = [newton_step(m, newton_sums(x, fit_y, m) + part) for m, x, part in zip(models, fit_x, (sums[:stop], sums[stop:]))]
    rows = held if held.any() else np.ones(len(y), bool)
    z = [m.logit(v[rows]) for m, v in zip(models, views)]
    platt = [fit_logistic(a[:, None], y[rows], 1e-2) for a in z]
    cal = np.stack([p.logit(a[:, None]) for p, a in zip(platt, z)], 1)
    joint = fit_logistic(cal, y[rows], 5.0)
    bins = bins_of(joint.logit(cal))
    return Model(models, platt, joint, best_cut(*[np.bincount(bins[(y[rows] > 0.5) == t], minlength=BINS) for t in (False, True)]))


def spark_pool(views: DataFrame):
    """``pool_sums`` over all rows of ``views``. Every task gives one row of sums;
    tasks of the next level add up ``FAN_IN`` of those each, one after the other,
    until ``FEW`` are left for the driver."""
    import pyarrow as pa

    parts = max(1, views.rdd.getNumPartitions())

    def added(rows: Iterator[np.ndarray], number: int) -> Iterator:
        total = None
        for x in rows:
            total = x if total is None else total + x
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["part", "sums"])

    def sums(history: list[Handing], models: list[Logistic], task: str) -> np.ndarray:
        def first(batches: Iterator) -> Iterator:
            from pyspark import TaskContext

            yield from added((pool_sums([vectors_of(b.column(k), n) for k, n in ((0, SHAPES + PAIRS), (1, META))], history, models, task)
                              for b in batches if b.num_rows), TaskContext.get().partitionId())

        def more(batches: Iterator) -> Iterator:
            from pyspark import TaskContext

            yield from added((np.frombuffer(v, float) for b in batches for v in b.column(1).to_pylist()), TaskContext.get().partitionId())

        rows, left = views.select("text_view", "meta_view").mapInArrow(first, "part int, sums binary"), parts
        while left > FEW:
            left = max(1, left // FAN_IN)
            rows = rows.repartition(left, "part").sortWithinPartitions("part").mapInArrow(more, "part int, sums binary")
        got = sorted(rows.collect(), key=lambda r: r.part)
        if not got:
            return pool_sums([np.zeros((0, SHAPES + PAIRS)), np.zeros((0, META))], history, models, task)
        return np.sum([np.frombuffer(r.sums, float) for r in got], axis=0)

    return sums


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality",
        cols: tuple = ("doc_id", "text", "lang", "source", "n_chars"), views: DataFrame | None = None) -> Model | None:
    """Train on the bounded labelled sample (rows of the smallest id hashes, at
    most four fifths of a class) and all unlabelled rows. All other labelled rows
    choose the threshold. ``views``: the staged ``features`` of ``docs``, if known."""
    one = (labels.select(F.col("doc_id").alias("__id"), F.col(label).cast("int").alias("y")).where("__id is not null and y in (0, 1)")
           .groupBy("__id").agg(F.max("y").alias("y")).where(~is_held_out("__id")))
    one = stage(one, "labelled")
    first = [F.xxhash64("__id"), F.col("__id")]
    count = {r.y: r.n for r in one.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(count) < 2:
        return None
    part = {y: one.where(F.col("y") == y).orderBy(*first).limit(min(SAMPLE, n - n // 5)) for y, n in count.items()}
    picked = part[1].unionByName(part[0])
    if views is None:
        views = stage(features(docs, cols), "views")
    views = views.where(~is_held_out("id")).select("id", "t", "text_view", "meta_view")
    named = stage(picked.select(F.col("__id").alias("__sample"), F.col("y").alias("__y")), "sample")
    got = (views.join(F.broadcast(named), F.col("id") == F.col("__sample")).groupBy("id")
           .agg(F.min("__y").alias("__y"), F.min(F.struct("t", "meta_view", "text_view")).alias("v")).select("id", "__y", "v.*").toArrow())
    if not got.num_rows:
        return None
    order = np.argsort(got["id"].to_numpy(zero_copy_only=False), kind="stable")
    vectors = [vectors_of(got[c], n)[order] for c, n in (("text_view", SHAPES + PAIRS), ("meta_view", META))]
    y = got["__y"].to_numpy()[order].astype(float)
    if len({*y}) < 2:
        return None
    pool = stage(views.join(one, F.col("id") == F.col("__id"), "left_anti").select("text_view", "meta_view"), "pool")
    model = co_train(vectors, y, spark_pool(pool))
    unseen = one.join(F.broadcast(named), F.col("__id") == F.col("__sample"), "left_anti")
    poor, good = score_histogram(views, unseen, model)
    if poor.any() and good.any():
        model.threshold = best_cut(poor, good)
    return model


def score_histogram(views: DataFrame, labelled: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Rows of either label per score bin; an id that occurs in several rows counts once, by its lowest."""
    import pyarrow as pa

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            x = [vectors_of(batch.column(i), n) for i, n in ((1, SHAPES + PAIRS), (2, META))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.bins(x))], names=["id", "bin"])

    kind = views.schema["id"].dataType.simpleString()
    bins = views.select("id", "text_view", "meta_view").mapInArrow(run, f"id {kind}, bin int").groupBy("id").agg(F.min("bin").alias("bin"))
    rows = bins.join(labelled, F.col("id") == F.col("__id")).groupBy("y", "bin").agg(F.count(F.lit(1)).alias("n")).collect()
    out = np.zeros((2, BINS), np.int64)
    for r in rows:
        out[r.y, r.bin] = r.n
    return out[0], out[1]


def vectors_of(column, n: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(-1, n).astype(float)


def score(docs: DataFrame, model: Model | None, cols: tuple = ("doc_id", "text", "lang", "source", "n_chars"),
          views: DataFrame | None = None) -> DataFrame:
    """(id, text_score, meta_score, score, good) per row; ``views``: the staged
    ``features`` of ``docs``, if known."""
    import pyarrow as pa

    if model is None:
        one = F.lit(1.0)
        return docs.select(F.col(f"`{cols[0]}`").alias("id"), one.alias("text_score"), one.alias("meta_score"), one.alias("score"),
                           F.lit(True).alias("good"))
    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            s = model.scores([vectors_of(batch.column(k), n) for k, n in ((1, SHAPES + PAIRS), (2, META))])
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(x, pa.float64()) for x in s], pa.array(s[2] >= model.threshold)],
                                             names=["id", "text_score", "meta_score", "score", "good"])

    own = (features(docs, cols) if views is None else views).select("id", "text_view", "meta_view")
    return own.mapInArrow(run, f"id {own.schema['id'].dataType.simpleString()}, text_score double, meta_score double, score double, good boolean")


def fit_and_score(docs: DataFrame, labels: DataFrame, cols: tuple = ("doc_id", "text", "lang", "source", "n_chars")) -> DataFrame:
    """``score`` by the model ``fit`` to the same rows; texts are read once."""
    views = stage(features(docs, cols), "views")
    return score(docs, fit(docs, labels, cols=cols, views=views), cols, views)


def drop_poor_documents(docs: DataFrame, labels: DataFrame, cols: tuple = ("doc_id", "text", "lang", "source", "n_chars")) -> DataFrame:
    """The rows of ``docs`` that are good, all columns unchanged; texts are read once."""
    import pyarrow as pa

    views = stage(features(docs, cols, carry=True), "views")
    model = fit(docs, labels, cols=cols, views=views)
    if model is None:
        return docs
    kept = views.select(*[f"c{k}" for k in range(len(docs.columns))], "text_view", "meta_view")

    def keep(batches: Iterator) -> Iterator:
        for batch in batches:
            last = batch.num_columns - 2
            x = [vectors_of(batch.column(last + k), n) for k, n in ((0, SHAPES + PAIRS), (1, META))]
            yield batch.select(list(range(last))).filter(pa.array(model.scores(x)[2] >= model.threshold))

    own = kept.drop("text_view", "meta_view").schema
    return kept.mapInArrow(keep, own).toDF(*docs.columns)
