"""Suffix-array dedup: bytes of repeated passages, by a hash-compared suffix sort.

A byte goes when a string of ``length`` bytes around it also starts anywhere
else. Sorting the suffixes of all texts shows this: equal strings become
neighbours. Three steps keep the sort small, exact and spread:

1. Anchors. The smallest hash of the ``gram``-byte strings inside a window of
   ``length`` bytes depends on the window's bytes only, so equal windows have
   equal anchors. Grams that are the anchor of one position only are counted
   out: windows on them occur once. (About 2 anchors per ``length`` bytes.)
2. Contexts. A run of windows on the same anchor position becomes one context:
   the bytes they cover. Equal contexts collapse (with a count, combined
   before the shuffle), so a passage copied into a third of the corpus is one.
3. Suffix sort. Contexts are dealt by anchor. A task concatenates the contexts
   of many anchors, takes prefix polynomial hashes (mod 2**64), and merge-sorts
   the window starts of each (anchor, offset): two suffixes are compared by a
   binary search for their common extension with prefix hashes, then one byte.
   Neighbours whose common extension reaches ``length`` are compared byte by
   byte; if a hash ever collided, the block is sorted by its bytes instead.

An anchor with more than ``GROUP`` distinct contexts (the edges of a passage in
very many texts) would be a large group in one task. Its contexts are cut into
shorter runs of windows, and the bytes that all windows of a run share join the
anchor, so the group falls apart by content; in steps of 16, 4 and 1 windows. A
run of one window is all anchor: its group holds equal windows only, which
collapse to one context. The result is the same.

Defined results: texts are UTF-8 bytes, null is empty; matches never cross
documents; overlapping matches count; strings are judged on the input. Texts
shorter than ``length`` lose nothing. Repeated rows repeat each other, so both
lose all bytes (from ``length`` on). An empty table gives no rows. Only id and
text are read. A very long text is read in pieces of ``CHUNK`` bytes by one task;
in text of a short period equal neighbouring contexts are one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.common import bounded_batches, stage, text_hash, worker_cache

GRAM = 40
#: distinct contexts of an anchor that are sorted in one task; larger groups are cut by runs of so many windows
GROUP, STEPS = 1024, (16, 4, 1)
#: bytes of contexts sorted at once, and bytes of a text hashed at once
BLOCK, CHUNK = 1 << 20, 1 << 20
BASE = 0x9E3779B97F4A7C15          # odd: invertible mod 2**64


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i mod 2**64 for i <= n; kept by the worker."""
    cache = worker_cache("powers")
    if len(cache.get("up", ())) <= n:
        size = max(n + 1, 1 << 16)
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            cache[name] = np.multiply.accumulate(p)
    return cache["up"], cache["down"]


def prefix_hashes(raw: np.ndarray) -> np.ndarray:
    """p[i]: polynomial hash of the first i bytes."""
    up, _ = _powers(len(raw))
    p = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:len(raw)], out=p[1:])
    return p


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _sliding(x: np.ndarray, w: int, op) -> np.ndarray:
    """op over every w consecutive values (by blocks: running results from both ends)."""
    n = len(x) - w + 1
    fill = np.uint64(0) if op is np.maximum else np.uint64(0xFFFFFFFFFFFFFFFF)
    rows = -(-len(x) // w)
    grid = np.full(rows * w, fill, np.uint64)
    grid[:len(x)] = x
    grid = grid.reshape(rows, w)
    ahead = op.accumulate(grid, axis=1).ravel()
    back = op.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(back[:n], ahead[w - 1:w - 1 + n])


def anchors(raw: np.ndarray, length: int, gram: int):
    """(gram hashes, smallest hash per window, positions that are an anchor)."""
    w = length - gram + 1
    p = prefix_hashes(raw)
    _, down = _powers(len(raw))
    n = len(raw) - gram + 1
    h = _mix((p[gram:] - p[:n]) * down[:n])
    least = _sliding(h, w, np.minimum)
    # a position is an anchor if the largest of the minima of the windows over it is its own hash
    pad = np.zeros(w - 1, np.uint64)
    return h, least, np.flatnonzero(_sliding(np.concatenate([pad, least, pad]), w, np.maximum) == h)


def _chunks(raw: np.ndarray, length: int):
    for s in range(0, max(0, len(raw) - length + 1), CHUNK):
        yield s, raw[s:s + CHUNK + length - 1]


def text_anchors(raw: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchor hashes of a text and their numbers of positions."""
    found = [h[at] for h, _, at in (anchors(part, length, gram) for _, part in _chunks(raw, length))]
    return np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def text_contexts(raw: np.ndarray, repeated: np.ndarray, length: int, gram: int):
    """(anchor hash, lead, start, end, times, shift) of each run of windows on one
    repeated anchor position; lead: from the run's start to the anchor. In text of
    a short period the runs that follow each other cover equal bytes, ``shift``
    apart: they are one row that stands for ``times`` of them."""
    data = raw.tobytes()
    repeated = np.sort(repeated)
    for base, part in _chunks(raw, length):
        h, least, at = anchors(part, length, gram)
        place = np.searchsorted(repeated, least)
        starts = np.flatnonzero(repeated[np.minimum(place, len(repeated) - 1)] == least)
        if not len(starts):
            continue
        names, code = np.unique(h[at], return_inverse=True)
        keys = code.astype(np.int64) * len(h) + at
        order = np.argsort(keys)
        first = np.searchsorted(keys[order], np.searchsorted(names, least[starts]).astype(np.int64) * len(h) + starts)
        spot = at[order][first]                       # the leftmost anchor of each window
        cut = np.flatnonzero((np.diff(starts) != 1) | (np.diff(spot) != 0)) + 1
        lo, hi = np.concatenate([[0], cut]), np.concatenate([cut, [len(starts)]]) - 1
        g, lead, a, b = least[starts[lo]].view(np.int64), spot[lo] - starts[lo], base + starts[lo], base + starts[hi] + length
        # a run that starts where the one before it ends, with its anchor, lead and size: equal if the bytes are
        like = np.concatenate([[False], (g[1:] == g[:-1]) & (lead[1:] == lead[:-1]) & (b[1:] - a[1:] == b[:-1] - a[:-1]) & (a[1:] == b[:-1] - length + 1)])
        for k in np.flatnonzero(like).tolist():
            like[k] = data[a[k]:b[k]] == data[a[k - 1]:b[k - 1]]
        head = np.flatnonzero(~like)
        times = np.diff(np.append(head, len(a)))
        yield from zip(*(x.tolist() for x in (g[head], lead[head], a[head], b[head], times, (b - a)[head] - length + 1)))


class Suffixes:
    """Compares suffixes of a buffer by their first ``length`` bytes."""

    def __init__(self, buf: np.ndarray, length: int) -> None:
        self.buf, self.length, self.p = buf, length, prefix_hashes(buf)
        _, self.down = _powers(len(buf))

    def _hash(self, i, n):
        return (self.p[i + n] - self.p[i]) * self.down[i]

    def extension(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common extension, at most ``length``."""
        out = np.full(len(i), self.length, np.int64)
        open_ = np.flatnonzero(self._hash(i, self.length) != self._hash(j, self.length))
        i, j = i[open_], j[open_]
        lo, hi = np.zeros(len(i), np.int64), np.full(len(i), self.length, np.int64)   # equal at lo, different at hi
        for _ in range(int(self.length).bit_length()):
            mid = (lo + hi) >> 1
            same = self._hash(i, mid) == self._hash(j, mid)
            lo, hi = np.where(same, mid, lo), np.where(same, hi, np.maximum(mid, lo + 1))
        out[open_] = lo
        return out

    def order_of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Negative, zero or positive as suffix i is less, equal or greater."""
        n = self.extension(i, j)
        equal = n >= self.length
        n = np.where(equal, 0, n)
        return np.where(equal, 0, self.buf[i + n].astype(np.int64) - self.buf[j + n])

    def sort(self, items: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Merge sort inside segments: ``first``, ``size``: start and length of
        the segment of every place. All segments are merged level by level: the
        new place of an item is its own rank plus its rank in the sibling run."""
        items, width = items.copy(), 1
        while width < size.max(initial=0):
            at = np.flatnonzero(size > width)
            local = at - first[at]
            run = local // width
            other = (run ^ 1) * width
            lo, hi = np.zeros(len(at), np.int64), np.clip(size[at] - other, 0, width)
            odd = run & 1
            while True:
                open_ = np.flatnonzero(lo < hi)
                if not len(open_):
                    break
                mid = (lo[open_] + hi[open_]) >> 1
                c = self.order_of(items[first[at[open_]] + other[open_] + mid], items[at[open_]])
                before = (c < 0) | ((c == 0) & (odd[open_] == 1))     # ties: the left run first
                lo[open_] = np.where(before, mid + 1, lo[open_])
                hi[open_] = np.where(before, hi[open_], mid)
            new = items.copy()
            new[first[at] + (run & ~1) * width + local % width + lo] = items[at]
            items, width = new, width * 2
        return items

    def equal_bytes(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        span, out = np.arange(self.length), np.ones(len(i), bool)
        for s in range(0, len(i), 4096):
            out[s:s + 4096] = (self.buf[i[s:s + 4096, None] + span] == self.buf[j[s:s + 4096, None] + span]).all(1)
        return out


def repeated_windows(group: np.ndarray, lead: np.ndarray, count: np.ndarray, texts: list[bytes], length: int) -> list[np.ndarray]:
    """For each context, which of its windows occur elsewhere (in a context of
    the same anchor, or because the context itself occurs twice)."""
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.concatenate([[0], np.cumsum(lens)[:-1]])
    windows = lens - length + 1
    owner = np.repeat(np.arange(len(texts)), windows)
    inside = np.arange(len(owner)) - np.repeat(np.concatenate([[0], np.cumsum(windows)[:-1]]), windows)
    hit = count[owner] > 1
    # segments: windows with the anchor at the same offset
    order = np.lexsort((lead[owner] - inside, group[owner]))
    offset, g = (lead[owner] - inside)[order], group[owner][order]
    new = np.concatenate([[True], (np.diff(offset) != 0) | (np.diff(g) != 0)])
    head = np.flatnonzero(new)
    size = np.diff(np.append(head, len(order)))
    many = np.repeat(size > 1, size)                      # a window alone needs no sort
    items = order[many]
    size = size[size > 1]
    if len(items):
        head = np.concatenate([[0], np.cumsum(size)[:-1]])
        seg = np.repeat(np.arange(len(size)), size)
        s = Suffixes(np.frombuffer(b"".join(texts), np.uint8), length)
        position = starts[owner] + inside
        where = s.sort(position[items], np.repeat(head, size), np.repeat(size, size))
        same = np.flatnonzero(seg[1:] == seg[:-1])
        same = same[s.extension(where[same], where[same + 1]) >= length]
        checked = s.equal_bytes(where[same], where[same + 1])
        item_of = np.zeros(len(s.buf), np.int64)
        item_of[position] = np.arange(len(position))
        if checked.all():
            hit[item_of[where[same]]] = hit[item_of[where[same + 1]]] = True
        else:                                             # a collision: sort this block by its bytes
            rows = s.buf[position[items][:, None] + np.arange(length)]
            _, inverse, n = np.unique(np.concatenate([seg[:, None].astype(">u4").view(np.uint8).reshape(-1, 4), rows], axis=1),
                                      axis=0, return_inverse=True, return_counts=True)
            hit[items[n[inverse.ravel()] > 1]] = True
    return np.split(hit, np.cumsum(windows)[:-1])


def _runs(mask: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), (edge[1::2] - 1).tolist()))


def repeated_spans(docs: DataFrame, length: int = 200, gram: int = GRAM, group: int = GROUP,
                   id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, spans). rows: (id, raw, text) of the documents that share an
    anchor with anything, written to the shared folder; spans: (id, raw, start,
    end) of bytes to remove, overlapping, for documents with any."""
    import pyarrow as pa

    bounded_batches(docs.sparkSession)
    text = F.col(f"`{text_col}`").cast("string")
    own = docs.select(F.col(f"`{id_col}`").alias("id"), text_hash(text).alias("raw"), F.encode(F.coalesce(text, F.lit("")), "utf-8").alias("text"))
    kind = own.schema["id"].dataType.simpleString()

    def find_anchors(batches: Iterator) -> Iterator:
        for batch in batches:
            found = [text_anchors(np.frombuffer(t, np.uint8), length, gram) for t in batch.column(2).to_pylist()]
            rows = pa.array(np.repeat(np.arange(len(found)), [len(g) for g, _ in found]))
            if len(rows):
                yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows),
                                                  pa.array(np.concatenate([g for g, _ in found]).view(np.int64)),
                                                  pa.array(np.concatenate([c for _, c in found]).astype(np.int32))], names=["id", "raw", "g", "c"])

    found = stage(own.where(F.octet_length("text") >= length).mapInArrow(find_anchors, f"id {kind}, raw bigint, g bigint, c int"), "anchors")
    repeated = found.groupBy("g").agg(F.sum("c").alias("c")).where("c > 1").select("g")
    lists = (found.join(repeated, "g").groupBy("id", "raw").agg(F.collect_set("g").alias("gs"))
             .select(F.col("id").alias("__id"), F.col("raw").alias("__raw"), "gs"))
    rows = stage(own.join(lists, F.col("id").eqNullSafe(F.col("__id")) & (F.col("raw") == F.col("__raw"))).select("id", "raw", "text", "gs"), "sharing")

    def find_contexts(batches: Iterator) -> Iterator:
        """Batches of at most some ``BLOCK`` bytes of contexts, however long a text is."""
        def frame(batch, out: list) -> pa.RecordBatch:
            at = pa.array(out[0], pa.int64())
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int32())
            return pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), *[pa.array(o, k) for o, k in zip(out[1:], kinds)]],
                                              names=["id", "raw", "g", "lead", "at", "ctx", "times", "shift"])

        for batch in batches:
            out, held = [[] for _ in range(7)], 0
            for r, (t, gs) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                for g, lead, a, b, times, shift in text_contexts(np.frombuffer(t, np.uint8), np.array(gs, np.int64).view(np.uint64), length, gram):
                    for o, v in zip(out, (r, g, lead, a, t[a:b], times, shift)):
                        o.append(v)
                    held += b - a
                    if held > 4 * BLOCK:
                        yield frame(batch, out)
                        out, held = [[] for _ in range(7)], 0
            if out[0]:
                yield frame(batch, out)

    contexts = rows.mapInArrow(find_contexts, f"id {kind}, raw bigint, g bigint, lead int, at bigint, ctx binary, times bigint, shift int")
    spans = None
    for step in (*STEPS, None):
        contexts = stage(contexts.withColumn("h", F.xxhash64("ctx")).withColumn("h2", F.hash("ctx")).withColumn("n", F.octet_length("ctx")), "contexts")
        distinct = stage(contexts.groupBy(*KEY, "ctx").agg(F.sum("times").alias("c")), "distinct")
        large = stage(distinct.groupBy("g").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > group).select("g"), "large")
        last = step is None or large.isEmpty()
        small = distinct if last else distinct.join(large, "g", "left_anti").select(*distinct.columns)
        hits = sorted_windows(small, length)
        # of a context that stands for several all windows are repeated; a shift is shorter than a window, so one span holds them
        end = F.col("at") + F.col("w1") + length + (F.col("times") - 1) * F.col("shift")
        found = (contexts.select("id", "raw", "at", "times", "shift", *KEY).join(hits, KEY)
                 .select("id", "raw", (F.col("at") + F.col("w0")).alias("start"), end.alias("end")))
        spans = found if spans is None else spans.unionByName(found)
        if last:
            break
        contexts = split_contexts(contexts.join(large, "g"), step, length)
    return rows, stage(spans, "spans")


#: a context's anchor, lead, two independent hashes and length
KEY = ["g", "lead", "h", "h2", "n"]


def split_contexts(contexts: DataFrame, step: int, length: int) -> DataFrame:
    """Cuts contexts into runs of windows whose offsets from the anchor lie in
    one block of ``step``. All windows of a block share the bytes between the
    last start and the first end, so these bytes become part of the anchor:
    equal windows still meet, and contexts that differ there part."""
    first, least = F.col("lead"), F.col("lead") - (F.col("n") - length)
    out = contexts.withColumn("b", F.explode(F.sequence(F.floor(least / step), F.floor(first / step))))
    top = F.least(F.col("b") * step + (step - 1), first)               # offset of the piece's first window
    end = F.greatest(F.col("b") * step, least)                         # and of its last
    out = out.withColumn("w0", (first - top).cast("int")).withColumn("w1", (first - end).cast("int"))
    shared = F.substring("ctx", (first - F.col("b") * step + 1).cast("int"), F.lit(length - step + 1))
    return out.select("id", "raw", F.xxhash64("g", "b", shared).alias("g"), top.cast("int").alias("lead"), (F.col("at") + F.col("w0")).alias("at"),
                      F.substring("ctx", F.col("w0") + 1, F.col("w1") - F.col("w0") + length).alias("ctx"), "times", "shift")


def sorted_windows(distinct: DataFrame, length: int) -> DataFrame:
    """(*KEY, w0, w1): runs of repeated windows of distinct contexts,
    from a suffix sort of each anchor's contexts."""
    import pyarrow as pa

    names = KEY

    def sort_block(batches: Iterator) -> Iterator:
        """Rows come sorted by anchor; whole anchors are sorted together."""
        def done(held: list) -> pa.RecordBatch:
            g, lead, h, h2, n, texts, c = zip(*held)
            out = [[] for _ in range(7)]
            masks = repeated_windows(np.array(g, np.int64), np.array(lead, np.int64), np.array(c, np.int64), list(texts), length)
            for k, mask in enumerate(masks):
                for a, b in _runs(mask):
                    for o, v in zip(out, (g[k], lead[k], h[k], h2[k], n[k], a, b)):
                        o.append(v)
            return pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32()))],
                                              names=[*names, "w0", "w1"])

        held, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(x).to_pylist() for x in (*names, "ctx", "c"))):
                if size > BLOCK and held[-1][0] != row[0]:
                    yield done(held)
                    held, size = [], 0
                held.append(row)
                size += row[4]
        if held:
            yield done(held)

    rows = distinct.select(*KEY, "ctx", "c").repartition("g").sortWithinPartitions("g")
    return rows.mapInArrow(sort_block, "g bigint, lead int, h bigint, h2 int, n int, w0 int, w1 int")


def remove(text: bytes, spans: list) -> tuple[bytes, int, int]:
    """(remaining bytes, bytes removed, maximal removed runs)."""
    if not spans:
        return text, 0, 0
    s = np.array(sorted(spans), np.int64)
    top = np.maximum.accumulate(s[:, 1])
    new = np.concatenate([[True], s[1:, 0] > top[:-1]])
    starts, ends = s[new, 0].tolist(), top[np.append(np.flatnonzero(new)[1:] - 1, len(s) - 1)].tolist()
    kept, at = [], 0
    for a, b in zip(starts, ends):
        kept.append(text[at:a])
        at = b
    return b"".join([*kept, text[at:]]), sum(ends) - sum(starts), len(starts)


def drop_repeats(docs: DataFrame, length: int = 200, gram: int = GRAM, group: int = GROUP, id_col: str = "doc_id",
                 text_col: str = "text", with_text: bool = True) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256[, kept bytes]) per row."""
    import pyarrow as pa

    rows, spans = repeated_spans(docs, length, gram, group, id_col, text_col)
    lists = (spans.groupBy("id", "raw").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
             .select(F.col("id").alias("__id"), F.col("raw").alias("__raw"), "spans"))
    hit = rows.join(lists, F.col("id").eqNullSafe(F.col("__id")) & (F.col("raw") == F.col("__raw"))).select("id", "raw", "text", "spans")
    kind = rows.schema["id"].dataType.simpleString()

    def cut(batches: Iterator) -> Iterator:
        import hashlib

        for batch in batches:
            out = [[] for _ in range(5)]
            for t, found in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                kept, removed, n = remove(t, [(x["start"], x["end"]) for x in found])
                for o, v in zip(out, (len(t), removed, n, hashlib.sha256(kept).hexdigest(), kept)):
                    o.append(v)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(o, k) for o, k in
                                              zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()))]],
                                             names=["id", "raw", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    changed = hit.mapInArrow(cut, f"id {kind}, raw bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")
    names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * with_text]
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    zero = F.lit(0).cast("long")
    whole = docs.select(F.col(f"`{id_col}`").alias("id"), text_hash(F.col(f"`{text_col}`").cast("string")).alias("raw"),
                        F.octet_length(text).cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"),
                        F.sha2(text, 256).alias("kept_sha256"), *([F.encode(text, "utf-8").alias("kept")] if with_text else []))
    ids = lists.select("__id", "__raw")
    same = whole.join(ids, F.col("id").eqNullSafe(F.col("__id")) & (F.col("raw") == F.col("__raw")), "left_anti")
    return same.select(*names).unionByName(changed.select(*names))
