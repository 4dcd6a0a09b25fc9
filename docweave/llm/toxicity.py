"""Toxicity: a small convolutional text classifier trained in numpy.

A word is the sum of hashed embeddings: of the word itself and of its first
four and five bytes (inflected forms share them). Filters of widths 1, 2 and 3
slide over the words, each keeps its largest response (max pooling), and a
logistic layer scores the pooled responses. Embeddings, filters and logistic
layer are trained together by AdaGrad on the driver, on a bounded sample of
labelled rows; one embedding dimension starts at the label's z-score of its
hash bucket, so rare signal words are found in few passes.

Thresholds are calibrated by language: on rows that training did not see, the
best threshold of each language is chosen, and scores are shifted so that 0.3
is the threshold everywhere. The language is read off the text (counts of
common function words), never from a column.

Scoring reads whole texts. A filter's response to a word does not depend on
the text, so a worker keeps the responses of words it has seen (bounded memo)
and a text costs one lookup and a few additions per word.

Defined results: null and empty texts and texts without letters pool to zeros
and get a score like any other; repeated rows get equal scores; rows without a
label, or with a null label, only get scores; an empty table gives no rows; no
labelled rows at all give score 0 everywhere. Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.common import bounded_batches, worker_cache

#: bounds of the labelled sample that trains the model: rows of each class, and bytes of text in all
SAMPLE_TOXIC, SAMPLE_CLEAN, SAMPLE_BYTES = 4000, 8000, 64 << 20
WORD = rb"[a-z\x80-\xff]+"
WIDTHS = (1, 2, 3)
BUCKETS, DIM, FILTERS = 1 << 15, 8, 8
#: words whose filter responses a worker keeps
MEMO_WORDS = 150_000
DECISION = 0.3

# Common function words by language.
FUNCTION_WORDS = {
    "en": "the of and to in is that for was on with as it be this from have are not",
    "de": "der die und den von zu das mit sich auf für ist im dem nicht ein eine als auch einer",
    "fr": "le les des et une du est pour dans qui par sur au avec ne pas plus ce sont elle",
    "es": "el los y se del las por con una su para lo como más o pero sus ha al fue",
}
LANGS = (*FUNCTION_WORDS, "other")


def bucket_ids(word: bytes) -> tuple[int, int, int]:
    import zlib

    return (zlib.crc32(word) % BUCKETS, zlib.crc32(b"4:" + word[:4]) % BUCKETS, zlib.crc32(b"5:" + word[:5]) % BUCKETS)


def _function_words() -> dict[bytes, int]:
    found: dict[bytes, int] = {}
    for k, words in enumerate(FUNCTION_WORDS.values()):
        for w in words.split():
            found[w.encode()] = k
    return found


@dataclass
class Model:
    table: np.ndarray                      # buckets x DIM
    filters: list[np.ndarray]              # per width: width x DIM x FILTERS
    bias: np.ndarray                       # one per filter
    weights: np.ndarray                    # one per filter
    offset: float
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(len(LANGS)))
    slope: float = 1.0

    def responses(self, buckets: np.ndarray) -> np.ndarray:
        """words x (sum of widths * FILTERS): each filter position's product
        with the word's embedding."""
        e = self.table[buckets].sum(1)
        return np.concatenate([e @ f[j] for f in self.filters for j in range(len(f))], axis=1).astype(np.float32)

    def pooled(self, r: np.ndarray) -> np.ndarray:
        """Max-pooled filter outputs of one text; r: its words' responses.
        A window that reaches past the end sees zero vectors there."""
        n, at, out = len(r), 0, []
        if not n:
            return np.zeros(len(WIDTHS) * FILTERS)
        for w in WIDTHS:
            total = r[:, at:at + FILTERS].copy()
            for j in range(1, w):
                total[:n - j] += r[j:, at + j * FILTERS: at + (j + 1) * FILTERS]
            at += w * FILTERS
            out.append(total.max(0))
        return np.maximum(np.concatenate(out) + self.bias, 0)

    def logit(self, pooled: np.ndarray) -> np.ndarray:
        return pooled @ self.weights + self.offset

    def score(self, logit: np.ndarray, lang: np.ndarray) -> np.ndarray:
        z = self.slope * (logit - self.thresholds[lang]) + np.log(DECISION / (1 - DECISION))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def language_of(counts: np.ndarray) -> np.ndarray:
    return np.where(counts.max(-1) > 0, counts.argmax(-1), len(FUNCTION_WORDS))


def _sample(docs: DataFrame, labels: DataFrame, label: str, held_out: bool, sizes: dict[int, int],
            id_col: str, text_col: str) -> tuple[list[bytes], np.ndarray, dict[int, int]]:
    """(texts, labels, labelled rows of each class in the table): the bounded sample, smallest id hashes per class, one whole text
    of each, as many as fit the byte bound. Held-out rows have crc32(id) mod 4 = 2."""
    one = (labels.select(F.col("doc_id").alias("__id"), F.col(label).cast("int").alias("y")).where("__id is not null and y in (0, 1)")
           .groupBy("__id").agg(F.max("y").alias("y")).where(is_held_out("__id") == F.lit(held_out)))
    count = {r.y: r.n for r in one.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = None
    for y, n in sizes.items():
        part = one.where(F.col("y") == y).orderBy(F.xxhash64("__id"), "__id").limit(n)
        picked = part if picked is None else picked.unionByName(part)
    # an id that occurs in many rows gives one: the text of its smallest hash
    own = (docs.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").cast("string").alias("text"))
           .select("__id", "text", F.xxhash64("text").alias("t"), F.octet_length("text").alias("n")))
    rows = (own.join(F.broadcast(picked), "__id").where(F.col("n") <= SAMPLE_BYTES).groupBy("__id").agg(F.min(F.struct("t", "n")).alias("one"))
            .select("__id", F.xxhash64("__id").alias("h"), "one.t", "one.n"))
    ends, kept = 0, []
    for r in sorted(rows.collect(), key=lambda r: (r.h, r["__id"])):
        if ends + r.n <= SAMPLE_BYTES:
            ends += r.n
            kept.append((r["__id"], r.t, r.n))
    if not kept:
        return [], np.zeros(0), count
    ids = docs.sparkSession.createDataFrame(kept, f"__id {picked.schema['__id'].dataType.simpleString()}, t bigint, n int")
    got = (own.join(F.broadcast(ids), ["__id", "t", "n"]).dropDuplicates(["__id"])
           .join(F.broadcast(picked), "__id").select("__id", "y", "text").toArrow())
    order = sorted(range(got.num_rows), key=lambda i: (got["__id"][i].as_py(), got["text"][i].as_py() or ""))
    texts = [(got["text"][i].as_py() or "").encode() for i in order]
    return texts, np.array([got["y"][i].as_py() for i in order], dtype=float), count


def is_held_out(id_col: str):
    return F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 4 == 2


def train(texts: list[bytes], y: np.ndarray, epochs: tuple[int, int] = (6, 20), steps: int = 2000, batch: int = 32,
          rate: float = 0.1, seed: int = 7, count: dict[int, int] | None = None) -> Model:
    """One in five rows only calibrates; the others train, in as many passes as
    make ``steps`` batches, within the bounds ``epochs``. ``count``: rows of each
    class that the sample stands for; calibration weighs its rows accordingly, so
    thresholds do not depend on the sample's bounds."""
    import re

    rng = np.random.default_rng(seed)
    find, vocab, docs = re.compile(WORD).findall, {}, []
    for t in texts:
        docs.append(np.array([vocab.setdefault(w, len(vocab)) for w in find(t.lower())], dtype=np.int64))
    words = np.array([bucket_ids(w) for w in vocab], dtype=np.int64).reshape(-1, 3)
    speech = _function_words()
    lang_of_word = np.array([speech.get(w, -1) for w in vocab], dtype=np.int64)
    calibrates = np.arange(len(docs)) % 5 == 0
    if calibrates.all() or not y[~calibrates].any() or y[~calibrates].all():
        calibrates[:] = False

    table = rng.normal(0, 0.05, (BUCKETS, DIM))
    seen, hits, p = np.zeros(BUCKETS), np.zeros(BUCKETS), max(1e-3, y[~calibrates].mean())
    for d, label in zip((d for d, c in zip(docs, calibrates) if not c), y[~calibrates]):
        b = np.unique(words[np.unique(d)])
        seen[b] += 1
        hits[b] += label
    table[:, 0] = np.clip((hits - seen * p) / np.sqrt(seen * p * (1 - p) + 1), -4, 8) / 4
    filters = [rng.normal(0, 0.1, (w, DIM, FILTERS)) for w in WIDTHS]
    for f in filters:
        f[0, 0, :] = np.abs(f[0, 0, :]) + 0.3
    model = Model(table, filters, np.zeros(len(WIDTHS) * FILTERS), np.full(len(WIDTHS) * FILTERS, 0.1), float(np.log(p / (1 - p))))
    speed = {k: 1e-6 for k in ("w", "o", "b")} | {("f", i): 1e-6 for i in range(len(filters))}
    speed_table = np.full(BUCKETS, 1e-6)

    def step(key, grad):
        speed[key] = speed[key] + grad * grad
        return rate * grad / np.sqrt(speed[key])

    train_rows = np.flatnonzero(~calibrates)
    passes = int(np.clip(steps * batch // max(1, len(train_rows)), *epochs))
    for _ in range(passes if y.any() and not y.all() else 0):
        for chunk in np.array_split(rng.permutation(train_rows), max(1, len(train_rows) // batch)):
            own = [docs[i] for i in chunk]
            n = np.array([len(d) for d in own])
            # texts laid end to end with two zero words after each
            line = np.full(int((n + 2).sum()), -1)
            starts = np.concatenate([[0], np.cumsum(n + 2)[:-1]])
            for s, d in zip(starts, own):
                line[s:s + len(d)] = d
            x = model.table[words[line]].sum(1)
            x[line < 0] = 0
            pooled, spots = np.zeros((len(own), len(WIDTHS) * FILTERS)), np.zeros((len(own), len(WIDTHS) * FILTERS), dtype=np.int64)
            for i, f in enumerate(model.filters):
                out = sum(np.concatenate([(x @ f[j])[j:], np.zeros((j, FILTERS))]) for j in range(len(f)))
                cols = slice(i * FILTERS, (i + 1) * FILTERS)
                for k, (s, m) in enumerate(zip(starts, n)):
                    if m:
                        best = out[s:s + m].argmax(0)
                        spots[k, cols] = s + best
                        pooled[k, cols] = out[s + best, np.arange(FILTERS)]
            raw = pooled + model.bias
            raw[n == 0] = 0
            act = np.maximum(raw, 0)
            err = 1 / (1 + np.exp(-np.clip(model.logit(act), -30, 30))) - y[chunk]
            grad_act = err[:, None] * model.weights * (raw > 0)
            model.weights = model.weights - step("w", act.T @ err / len(own))
            model.offset -= float(step("o", err.mean()))
            model.bias = model.bias - step("b", grad_act.mean(0))
            touched, gains = [], []
            for i, f in enumerate(model.filters):
                cols = slice(i * FILTERS, (i + 1) * FILTERS)
                g, at = grad_act[:, cols] / len(own), spots[:, cols]
                grad_f = np.zeros_like(f)
                for j in range(len(f)):
                    grad_f[j] = np.einsum("kf,kfd->df", g, x[at + j])
                    touched.append((at + j).ravel())
                    gains.append((g[:, :, None] * f[j].T[None]).reshape(-1, DIM))
                model.filters[i] = f - step(("f", i), grad_f)
            at, gain = np.concatenate(touched), np.concatenate(gains)
            real = line[at] >= 0
            b, grad = words[line[at[real]]].ravel(), np.repeat(gain[real], 3, axis=0)
            rows, place = np.unique(b, return_inverse=True)
            total = np.zeros((len(rows), DIM))
            np.add.at(total, place, grad)
            speed_table[rows] += (total * total).mean(1)
            model.table[rows] -= rate * total / np.sqrt(speed_table[rows])[:, None]

    rows = np.flatnonzero(calibrates) if calibrates.any() else np.arange(len(docs))
    logit = np.array([float(model.logit(model.pooled(model.responses(words[docs[i]])))) for i in rows])
    counts = np.array([np.bincount(lang_of_word[docs[i]][lang_of_word[docs[i]] >= 0], minlength=len(FUNCTION_WORDS)) for i in rows])
    weight = np.ones(len(rows))
    for c, n in (count or {}).items():
        own = y[rows] == c
        weight[own] = n / max(1, own.sum())
    calibrate(model, logit, y[rows], language_of(counts.reshape(len(rows), -1)), weight / weight.mean())
    return model


def best_threshold(logit: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """Middle of the best F1 cut, of rows that weigh ``weight``."""
    order = np.argsort(logit, kind="stable")
    z, w = logit[order], weight[order]
    caught = np.append(np.cumsum((w * y[order])[::-1])[::-1], 0)
    f1 = 2 * caught[:-1] / (caught[0] + np.cumsum(w[::-1])[::-1])
    k = int(f1.argmax())
    return float(z[k] - 0.5 * (z[k] - z[k - 1]) if k else z[k] - 0.5)


def calibrate(model: Model, logit: np.ndarray, y: np.ndarray, lang: np.ndarray, weight: np.ndarray, least: int = 40) -> None:
    """The threshold of a language is drawn to the one over all rows as far as
    its rarer class has few rows: weight n / (n + ``least``)."""
    if not y.any() or y.all():
        return
    model.thresholds[:] = best_threshold(logit, y, weight)
    for k in range(len(LANGS)):
        own = lang == k
        n = min(y[own].sum(), (1 - y[own]).sum())
        if n:
            model.thresholds[k] += n / (n + least) * (best_threshold(logit[own], y[own], weight[own]) - model.thresholds[k])
    gap = np.median(logit[y == 1]) - np.median(logit[y == 0])
    model.slope = float(np.clip(8 / max(gap, 1e-6), 0.05, 20))


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) per row."""
    import pyarrow as pa

    spark = docs.sparkSession
    own = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    if model is None:
        return own.select("id", F.lit(0.0).alias("score"))
    shared, mark = spark.sparkContext.broadcast(model), f"toxicity:{id(model)}:{np.random.default_rng().integers(1 << 62)}"

    def run(batches: Iterator) -> Iterator:
        import re

        find, m, speech = re.compile(WORD).findall, shared.value, _function_words()
        cache = worker_cache("toxicity")
        if cache.get("of") != mark:
            cache.clear()
            cache |= {"of": mark, "memo": {}, "rows": np.zeros((MEMO_WORDS, sum(WIDTHS) * FILTERS), np.float32),
                      "speech": np.full(MEMO_WORDS, len(FUNCTION_WORDS), np.int64)}
        memo, rows, spoken = cache["memo"], cache["rows"], cache["speech"]

        def learn(new: list[bytes]) -> None:
            at = len(memo)
            rows[at:at + len(new)] = m.responses(np.array([bucket_ids(w) for w in new], dtype=np.int64))
            spoken[at:at + len(new)] = [speech.get(w, len(FUNCTION_WORDS)) for w in new]
            for w in new:
                memo[w] = len(memo)

        def text_parts(t: bytes | None):
            """(pooled, function word counts) of a whole text, in pieces of words
            that overlap by the widest filter."""
            words = find((t or b"").lower())
            best, counts = None, np.zeros(len(FUNCTION_WORDS) + 1, np.int64)
            size, step = 50_000, 50_000 - (max(WIDTHS) - 1)
            for s in range(0, max(1, len(words)), step):
                piece = words[s:s + size]
                new = list({w for w in piece if w not in memo})
                if len(memo) + len(new) > MEMO_WORDS:
                    memo.clear()
                    new = list(set(piece))
                if new:
                    learn(new)
                ids = np.array([memo[w] for w in piece], dtype=np.int64)
                pooled = m.pooled(rows[ids])
                counts += np.bincount(spoken[ids[:step]], minlength=len(FUNCTION_WORDS) + 1)
                best = pooled if best is None else np.maximum(best, pooled)
                if s + size >= len(words):
                    break
            return best, counts[:-1]

        for batch in batches:
            parts = [text_parts(t) for t in batch.column(1).cast(pa.large_binary()).to_pylist()]
            pooled = np.array([p for p, _ in parts]).reshape(len(parts), len(WIDTHS) * FILTERS)
            lang = language_of(np.array([c for _, c in parts]).reshape(len(parts), len(FUNCTION_WORDS)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(m.score(m.logit(pooled), lang), pa.float64())], names=["id", "score"])

    bounded_batches(spark)
    return own.mapInArrow(run, f"id {own.schema['id'].dataType.simpleString()}, score double")


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> Model | None:
    texts, y, count = _sample(docs, labels, label, False, {1: SAMPLE_TOXIC, 0: SAMPLE_CLEAN}, id_col, text_col)
    return train(texts, y, count=count) if len(y) else None
