"""The recursive separator splitter (C3) as column expressions.

A text is cut into pieces by the first separator it holds (each piece keeps its
separator in front); a piece of ``size`` or more is cut again by the next ones,
down to characters. Neighbouring small pieces are merged greedily into chunks,
a chunk's last pieces of at most ``overlap`` opening the next one.

Here the pieces of all levels come as one list, with a mark around every piece
that was cut again, since chunks do not cross it. A fold over the lengths then
moves a window's two ends, one piece a step, and notes the bounds of each full
window. No Python runs and a long text takes time in proportion (the one task
that has it holds its list of pieces).

Null and empty texts give no chunk. Lengths are pre-token counts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docweave.functions import metadata as md
from docweave.functions.patterns import SEPARATORS
from docweave.functions.text import pretokens, strip_text

#: a mark's length; pieces have at least one pre-token
_MARK = -1
_BOUNDS = "array<struct<s:int,e:int>>"


def _cut(text: Column, sep: str) -> Column:
    """(p, n): pieces of ``text`` and their lengths; each but the first opens with ``sep``."""
    if sep == "":
        return F.transform(F.split(text, "", -1), lambda p: F.struct(p.alias("p"), F.lit(1).alias("n")))
    parts = F.transform(F.split(text, sep, -1), lambda p, i: F.when(i == 0, p).otherwise(F.concat(F.lit(sep), p)))
    return F.transform(F.filter(parts, lambda p: p != ""), lambda p: F.struct(p.alias("p"), F.size(pretokens(p)).alias("n")))


def _cut_again(pieces: Column, size: int, seps: list[str]) -> Column:
    """Pieces of ``size`` or more replaced by their own pieces, between marks. A separator that
    a piece does not hold leaves it whole, for the next one."""
    if not seps:
        return pieces
    mark = F.array(F.struct(F.lit("").alias("p"), F.lit(_MARK).alias("n")))
    return F.flatten(F.transform(pieces, lambda x: F.when(x.n < size, F.array(x)).otherwise(
        F.concat(mark, _cut_again(_cut(x.p, seps[0]), size, seps[1:]), mark))))


def pieces(text: Column, size: int, separators: list[str] = SEPARATORS) -> Column:
    """All pieces of a text that are merged into chunks, marks between those that must not meet."""
    cut = _cut(text, separators[-1])
    for sep in reversed(separators[:-1]):
        cut = F.when(F.contains(text, F.lit(sep)), _cut(text, sep)).otherwise(cut)
    return _cut_again(cut, size, separators[1:])


def _windows(lengths: Column, size: int, overlap: int) -> Column:
    """Bounds (s, e) of the chunks over a list of lengths that ends with a mark.

    The fold's state is copied at every step, so it stays small: an inner fold of about
    the square root of all steps holds the bounds it found, an outer one joins them."""
    zero, yes, no = F.lit(0), F.lit(True), F.lit(False)
    none = F.array().cast(_BOUNDS)

    def state(i, s, total, shrinking, found):
        return F.struct(i.alias("i"), s.alias("s"), total.alias("total"), shrinking.alias("shrinking"), found.alias("found"))

    def step(a, _):
        n = F.get(lengths, a.i)
        opened = a.s < a.i
        over = (a.total + n > size) | (a.shrinking & (a.total > overlap))
        found = F.concat(a.found, F.array(F.struct(a.s.alias("s"), a.i.alias("e"))))
        return (F.when(n == _MARK, state(a.i + 1, a.i + 1, zero, no, F.when(opened, found).otherwise(a.found)))
                .when(over & opened, state(a.i, a.s + 1, a.total - F.get(lengths, a.s), yes,
                                           F.when(a.shrinking, a.found).otherwise(found)))
                .when(n.isNotNull(), state(a.i + 1, a.s, a.total + n, no, a.found))
                .otherwise(a))

    def some_steps(a, _):
        ran = F.aggregate(F.sequence(F.lit(1), some), state(a.i, a.s, a.total, a.shrinking, none), step)
        return md.bound(ran, lambda r: state(r.i, r.s, r.total, r.shrinking, F.concat(a.found, r.found)))

    # every piece enters the window once and leaves it at most once
    some = F.sqrt(F.size(lengths)).cast("int") * 4
    rounds = F.sequence(F.lit(1), F.ceil(F.size(lengths) * 2 / some).cast("int"))
    return F.aggregate(rounds, state(zero, zero, zero, no, none), some_steps, lambda a: a.found)


def split_chunks(text: Column, size: int, overlap: int, separators: list[str] = SEPARATORS) -> Column:
    """Array of the chunks of ``text``, stripped; empty ones are left out."""
    if size < 2 or not 0 <= overlap < size:
        raise ValueError("chunks need a size of at least 2 and an overlap below it")
    mark = F.array(F.struct(F.lit("").alias("p"), F.lit(_MARK).alias("n")))

    def bounds_of(ns):
        # pieces that fit one chunk need no fold
        total = F.aggregate(ns, F.lit(1), lambda a, n: a + n)
        return F.when((F.array_position(ns, _MARK) == F.size(ns)) & (total <= size),
                      F.array(F.struct(F.lit(0).alias("s"), (F.size(ns) - 1).alias("e")))).otherwise(_windows(ns, size, overlap))

    def joined(found):
        texts = F.transform(found, lambda x: x.p)
        bounds = md.bound(F.transform(found, lambda x: x.n), bounds_of)
        # by place, not by slice(), which copies the whole list for every chunk
        return md.bound(texts, lambda ts: F.transform(bounds, lambda b: strip_text(
            F.array_join(F.transform(F.sequence(b.s, b.e - 1), lambda i: F.get(ts, i)), ""))))

    def chunks(t):
        return F.when(t != "", F.filter(md.bound(F.concat(pieces(t, size, separators), mark), joined), lambda c: c != ""))

    # the text may be a long expression: as a lambda's value it runs once
    return md.bound(text, chunks)
