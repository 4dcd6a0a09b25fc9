"""Periodic runs of words, found by recompression.

A run is a stretch of words with smallest period q that no neighbouring word
extends, at least ``min_periods`` periods and ``min_words`` words long.

Grammar. The word numbers of a batch of texts, each text closed by a letter of
its own, are compressed in rounds: block compression names every maximal block of
one letter (letter, length), pair compression splits the letters in two halves by
a hash and names every pair of a left letter and a right one. Equal pairs get
equal names everywhere, so equal stretches have equal symbols but for a few at
their edges, and a run of n periods is a block after some rounds. The rounds'
sequences form a run-length grammar of logarithmic height.

Extensions. From two places, equal symbols are skipped while climbing to higher
rounds, and after the first difference while descending again; in a block of one
letter the shorter rest is skipped at once. A query takes a few steps per round;
all queries of a batch move together as arrays. The same rounds read from the
right give extensions to the left.

Candidates. A run of period q holds a stretch of at least
g = max((min_periods - 1) * q, min_words - q) places i with word i = word i + q,
so one of them is a multiple of g: for every q only the places 0, g, 2g, ... are
looked at (a harmonic sum, n log n in all), and those with equal words are
extended by two queries. Of equal stretches the smallest period stays.

A text is the unit of work: nothing is shuffled, and a batch is bounded in bytes.
Defined results: a null or blank text has no words and no run; repeated rows are
rows of their own; an empty table gives no rows; other columns are not read. A very
long text costs time in n log n and some 400 bytes a word in its task. Of runs
with equal exponents, the first by start, then period, is the best.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.functions.metadata import bound
from docweave.llm.common import ASCII_WORD, bounded_batches

#: candidate places looked at together
AT_ONCE = 1 << 20


class Round:
    """One sequence of the grammar, read in one direction. ``rest``: letters up to
    the end of the block a place lies in; ``up``: its symbol in the next round;
    ``opens``: whether that symbol starts here; ``down``: where a symbol's own
    letters start in the round before; ``size``: words of a symbol."""

    __slots__ = ("letters", "rest", "up", "opens", "down", "size")

    def __init__(self, letters, size):
        self.letters, self.size = letters, size
        self.rest = self.up = self.opens = self.down = None


def _names(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, int]:
    """Equal pairs get equal numbers, 0 to count - 1."""
    code, names = pd.factorize(a.astype(np.int64) << 32 | b)
    return code, len(names)


def grammar(words: np.ndarray, enough: int) -> list[Round]:
    """The rounds over ``words``, until at most ``enough`` symbols are left or
    nothing shrinks any more."""
    rounds = [Round(words.astype(np.int64), np.ones(len(words), np.int64))]
    idle, turn = 0, 0
    while len(rounds[-1].letters) > enough and idle < 12:
        now = rounds[-1]
        x, n = now.letters, len(now.letters)
        if turn % 2 == 0:
            head = np.ones(n, bool)
            head[1:] = x[1:] != x[:-1]
        else:
            # multiply and shift: an independent half of the letters each round
            left = (x * (0x9E3779B97F4A7C15 + 2 * turn * 0xBF58476D1CE4E5B & (1 << 63) - 1)).view(np.uint64) >> np.uint64(63) == 0
            head = np.ones(n, bool)
            head[1:] = ~(left[:-1] & ~left[1:])
        at = np.flatnonzero(head)
        if len(at) == n:
            idle, turn = idle + 1, turn + 1
            continue
        idle, turn = 0, turn + 1
        count = np.diff(np.append(at, n))
        # a block is (letter, count); a pair (left, right) is told from single letters by its second letter
        second = count if turn % 2 == 1 else np.where(count == 2, x[np.minimum(at + 1, n - 1)] + 1, 0)
        code, _ = _names(x[at], second)
        nxt = Round(code, np.add.reduceat(now.size, at))
        now.up, now.opens, nxt.down = np.cumsum(head) - 1, head, at
        if turn % 2 == 1:
            now.rest = np.repeat(at + count, count) - np.arange(n)
        rounds.append(nxt)
    return rounds


def mirrored(rounds: list[Round]) -> list[Round]:
    """The same grammar read from the right."""
    out = []
    for k, r in enumerate(rounds):
        m = Round(r.letters[::-1], r.size[::-1])
        n = len(r.letters)
        if r.up is not None:
            more = len(rounds[k + 1].letters)
            closes = np.ones(n, bool)
            closes[:-1] = r.opens[1:]
            m.up, m.opens = (more - 1 - r.up)[::-1], closes[::-1]
        if r.down is not None:
            before = len(rounds[k - 1].letters)
            last = np.append(r.down[1:], before) - 1
            m.down = (before - 1 - last)[::-1]
        if r.rest is not None:
            first = rounds[k + 1].down[r.up]
            m.rest = (np.arange(n) - first + 1)[::-1]
        out.append(m)
    return out


def _skip(r: Round, p, q, done, on):
    """Skip one symbol, or the shorter rest of two blocks, where letters agree."""
    step = np.ones(len(on), np.int64) if r.rest is None else np.minimum(r.rest[p[on]], r.rest[q[on]])
    done[on] += step * r.size[p[on]]
    p[on] += step
    q[on] += step


def extensions(rounds: list[Round], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For every pair of different places: how many words agree from there on.
    Texts end in letters of their own, so every query ends at a difference."""
    p, q = i.astype(np.int64), j.astype(np.int64)
    done, level = np.zeros(len(p), np.int64), np.zeros(len(p), np.int64)
    active = np.arange(len(p))
    for k, r in enumerate(rounds):              # climb
        if k:
            p[active], q[active] = rounds[k - 1].up[p[active]], rounds[k - 1].up[q[active]]
            level[active] = k
        if r.up is None:
            break
        on = active
        while len(on):
            on = on[r.letters[p[on]] == r.letters[q[on]]]
            # where both places open a symbol of the next round and the symbols agree, that round skips more
            a, b = p[on], q[on]
            lift = r.opens[a] & r.opens[b]
            on = on[~lift]
            if len(on):
                _skip(r, p, q, done, on)
        stay = (r.letters[p[active]] == r.letters[q[active]])
        active = active[stay]
        if not len(active):
            break
    for k in range(len(rounds) - 1, -1, -1):    # descend
        r = rounds[k]
        here = np.flatnonzero(level == k)
        on = here
        while len(on):
            on = on[r.letters[p[on]] == r.letters[q[on]]]
            if len(on):
                _skip(r, p, q, done, on)
        if k and len(here):
            p[here], q[here] = r.down[p[here]], r.down[q[here]]
            level[here] = k - 1
    return done


def find_runs(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray, min_words: int = 24, min_periods: int = 3,
              at_once: int = AT_ONCE) -> np.ndarray:
    """Rows (text, start, length, period), sorted, of all runs. ``words``: the word
    numbers of all texts, with a number of its own before the first and after each."""
    found = [np.zeros((0, 4), np.int64)]
    most = np.where(sizes >= min_words, sizes // min_periods, 0)
    total = len(words)
    forward = backward = None
    bounds = np.concatenate([[0], np.cumsum(most)])
    at = 0
    while at < bounds[-1]:
        # (text, period) pairs at .. stop, and the grid places of each
        stop = min(int(bounds[-1]), at + at_once)
        pair = np.arange(at, stop)
        text = np.searchsorted(bounds, pair, "right") - 1
        q = pair - bounds[text] + 1
        gap = np.maximum((min_periods - 1) * q, min_words - q)
        grid = -(-(sizes[text] - q) // gap)
        upto = np.cumsum(grid)
        if upto[-1] > at_once:
            cut = max(1, int(np.searchsorted(upto, at_once, "right")))
            stop, text, q, gap, grid, upto = at + cut, text[:cut], q[:cut], gap[:cut], grid[:cut], upto[:cut]
        at = stop
        row = np.repeat(np.arange(len(q)), grid)
        i = (np.arange(len(row)) - np.repeat(upto - grid, grid)) * gap[row] + starts[text[row]]
        period = q[row]
        same = words[i] == words[i + period]
        i, period, owner = i[same], period[same], text[row[same]]
        for t, a, b, p in long_runs(found, starts):
            # both places in a run whose period divides q: the extension would be that run again
            new = (owner != t) | (i < a) | (i + period >= b) | (period % p > 0)
            i, period, owner = i[new], period[new], owner[new]
        if not len(i):
            continue
        if forward is None:
            forward = grammar(words, max(64, 4 * len(sizes)))
            backward = mirrored(forward)
        right = extensions(forward, i, i + period)
        left = extensions(backward, total - i, total - i - period)        # from the words before
        length = left + right + period
        ok = length >= np.maximum(min_words, min_periods * period)
        rows = np.stack([owner[ok], i[ok] - left[ok] - starts[owner[ok]], length[ok], period[ok]], 1)
        found.append(np.unique(rows, axis=0))
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:, :3] != rows[:-1, :3]).any(1)       # of equal stretches the smallest period
    rows = rows[first]
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def long_runs(found: list[np.ndarray], starts: np.ndarray, least: int = 4096, most: int = 8) -> list[tuple[int, int, int, int]]:
    """(text, from, to, period) of the longest runs so far: they hold most of the
    remaining candidates of a text that repeats itself."""
    rows = np.concatenate(found)
    rows = rows[rows[:, 2] >= least]
    rows = rows[np.lexsort((rows[:, 3], -rows[:, 2]))]
    out, seen = [], set()
    for t, a, n, p in rows[:1000].tolist():
        if (t, a, n) not in seen and len(out) < most:        # of equal stretches the smallest period
            seen.add((t, a, n))
            out.append((t, a + int(starts[t]), a + int(starts[t]) + n, p))
    return out


def best_run(rows: np.ndarray) -> int:
    """Index of the run with the greatest exact length / period, then least start and period."""
    ratio = rows[:, 2] / rows[:, 3]
    best = -1
    for k in np.flatnonzero(ratio >= ratio.max() * (1 - 1e-9)):
        if best < 0 or int(rows[k, 2]) * int(rows[best, 3]) > int(rows[best, 2]) * int(rows[k, 3]):
            best = int(k)
    return best


RESULT = ("n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, "
          "collapsed_sha256 string")


def describe(texts: list[bytes | None], min_words: int, min_periods: int, with_text: bool) -> dict[str, list]:
    """The result columns of a batch of texts."""
    split = [(t or b"").split() for t in texts]              # on bytes, split() is the ASCII white space
    sizes = np.array([len(w) for w in split], np.int64)
    starts = np.cumsum(sizes + 1) - sizes
    flat: list[bytes] = [w for ws in split for w in ws]
    numbers = pd.factorize(np.array(flat, dtype=object))[0] if flat else np.zeros(0, np.int64)
    words = np.empty(len(flat) + len(split) + 1, np.int64)
    own = np.append(starts - 1, len(words) - 1)              # a letter of its own closes every text
    inside = np.ones(len(words), bool)
    inside[own] = False
    words[inside] = numbers
    words[own] = len(flat) + np.arange(len(own))
    rows = find_runs(words, starts, sizes, min_words, min_periods)
    cut = np.searchsorted(rows[:, 0], np.arange(len(split) + 1))
    names = [c.split()[0] for c in RESULT.split(", ")] + ["collapsed", "runs"]
    out: dict[str, list] = {c: [] for c in names}
    for k, ws in enumerate(split):
        mine = rows[cut[k]:cut[k + 1]]
        best, kept = (None,) * 4, ws
        if len(mine):
            _, a, n, q = map(int, mine[best_run(mine)])
            best = (a, n, q, 1000 * n // q)
            edge = np.zeros(len(ws) + 1, np.int64)
            np.add.at(edge, mine[:, 1] + mine[:, 3], 1)
            np.add.at(edge, mine[:, 1] + mine[:, 2], -1)
            kept = [ws[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
        listed = "".join([f"{a},{n},{q}\n" for _, a, n, q in mine.tolist()])
        text = b" ".join(kept)
        values = (len(mine), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(text).hexdigest())
        for c, v in zip(names, values):
            out[c].append(v)
        if with_text:
            out["collapsed"].append(text.decode("utf-8", "replace"))
            out["runs"].append([{"start": a, "length": n, "period": q} for _, a, n, q in mine.tolist()])
    return out


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 24, min_periods: int = 3,
                  with_text: bool = False) -> DataFrame:
    """Per document: number of runs, the best run, digests of all runs and of the
    text without repeats of a period; ``with_text`` adds both themselves."""
    import pyarrow as pa

    run_type = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
    kinds = {"collapsed": pa.string(), "runs": run_type, "runs_sha256": pa.string(), "collapsed_sha256": pa.string()}

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            got = describe(batch.column(1).cast(pa.large_binary()).to_pylist(), min_words, min_periods, with_text)
            names = [c for c in got if with_text or c not in ("collapsed", "runs")]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(got[c], kinds.get(c, pa.int64())) for c in names]],
                                             names=["id", *names])

    bounded_batches(docs.sparkSession)
    own = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    more = ", collapsed string, runs array<struct<start:bigint,length:bigint,period:bigint>>" if with_text else ""
    return own.mapInArrow(run, f"id {own.schema['id'].dataType.simpleString()}, {RESULT}{more}")


def planted_text(text: Column, key: Column) -> Column:
    """Test periods planted in every tenth text: with h = crc32(decimal key) and
    g = h div 10, where h % 10 = 0 every word i >= a = g % n becomes word
    a + (i - a) % p, p = 1 + (n - a) div (3 + g % 8). Other texts stay."""
    h = F.crc32(key.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def rewritten(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = F.lit(1).cast("long") + F.floor((n - a) / (F.lit(3) + g % 8))
        place = bound(F.struct(a.alias("a"), p.alias("p"), n.alias("n")), lambda s: F.transform(
            F.sequence(F.lit(0).cast("long"), s["n"] - 1),
            lambda i: F.when(i < s["a"], i).otherwise(s["a"] + (i - s["a"]) % s["p"]).cast("int")))
        return F.when(n > 0, F.array_join(F.transform(place, lambda i: F.get(words, i)), " ")).otherwise(F.lit(""))

    return F.when(h % 10 == 0, bound(F.regexp_extract_all(text, F.lit(ASCII_WORD), 0), rewritten)).otherwise(text)
