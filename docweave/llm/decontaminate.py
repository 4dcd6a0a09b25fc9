"""Benchmark decontamination by a generalised suffix automaton of the test items.

Items and texts are normalised to words (A-Z lower-cased, maximal runs of
letters, digits and non-ASCII characters). One suffix automaton takes in all
items. Every document streams through it word by word; the automaton keeps the
length of the longest suffix read so far that occurs in an item. Where that
length reaches ``window``, the last ``window`` words are a window of some item:
they are hit. An item of fewer words is one window, found at the states whose
suffix links lead to its end.

The items of a window are kept once per window, at the one state on its path of
suffix links that holds strings of ``window`` words; a document gathers states,
then items.

Size: the items are counted first. Up to ``BLOCK_WORDS`` words make one
automaton, built on the driver and broadcast. More are cut into pieces that
overlap by ``window`` - 1 words (so every window lies in a piece) and dealt into
blocks of that bound; every block is one pass over all documents, and hits are
united by document. The documents are never shuffled in a pass.

``scan`` gives hits; ``decontaminate`` removes them from the texts, and drops
documents whose hit share exceeds a limit.

Defined results: a null text or item has no words; an item without words occurs
nowhere; a null item id counts as one item with an empty name; rows with the same
item id are one item; repeated documents are rows of their own; empty tables give
no rows or no hits. Other columns are not read. Very long texts are read in
slices of words; they stay one row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.common import bounded_batches, stage

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: words (a word of over 16 bytes counts for more) in one automaton, and in a piece of a longer item
BLOCK_WORDS, PIECE_WORDS = 200_000, 20_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Automaton:
    """Suffix automaton of several word sequences, and the items of their windows."""

    def __init__(self, window: int):
        self.window = window
        self.words: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        self.home: list[int] = []                  # the state of a state's suffix of ``window`` words
        self.items: dict[int, list[int]] = {}      # items of a home state
        self.short: dict[int, list[tuple[int, int]]] = {}      # (length, item) of whole short items
        self.near: list[int] = []                  # nearest state with short items along suffix links
        self.names: list[str] = []

    def _state(self, length: int, moves: dict[int, int], link: int) -> int:
        self.next.append(moves)
        self.len.append(length)
        self.link.append(link)
        return len(self.len) - 1

    def _apart(self, p: int, w: int) -> int:
        """The state of exactly the strings of ``p`` followed by ``w``."""
        q = self.next[p][w]
        if self.len[q] == self.len[p] + 1:
            return q
        copy = self._state(self.len[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def _append(self, last: int, w: int) -> int:
        if w in self.next[last]:
            return self._apart(last, w)
        new, p = self._state(self.len[last] + 1, {}, 0), last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._apart(p, w)
        return new

    def build(self, pieces: list[tuple[str, list[bytes]]]) -> Automaton:
        number: dict[str, int] = {}
        coded = []
        for name, words in pieces:
            item = number.setdefault(name, len(number))
            coded.append((item, [self.words.setdefault(w, len(self.words)) for w in words]))
        self.names = list(number)
        for _, words in coded:
            last = 0
            for w in words:
                last = self._append(last, w)
        self.home, self.near = [-1] * len(self.len), [-1] * len(self.len)
        order = sorted(range(1, len(self.len)), key=self.len.__getitem__)
        for v in order:
            if self.len[v] >= self.window:
                up = self.link[v]
                self.home[v] = v if self.len[up] < self.window else self.home[up]
        held: dict[int, set] = {}
        for item, words in coded:
            v = 0
            for i, w in enumerate(words):
                v = self.next[v][w]
                if i + 1 >= self.window:
                    held.setdefault(self.home[v], set()).add(item)
            if 0 < len(words) < self.window:
                self.short.setdefault(v, []).append((len(words), item))
        self.items = {v: sorted(s) for v, s in held.items()}
        for v in order:
            self.near[v] = v if v in self.short else self.near[self.link[v]] if self.link[v] > 0 else -1
        return self

    def read(self, raw: bytes | None) -> tuple[int, list[tuple[int, int]], set[int]]:
        """(number of words, hit spans as [from, to) word numbers, items) of a text."""
        moves, link, length, home, near, window = self.next, self.link, self.len, self.home, self.near, self.window
        code, v, n, i = self.words.get, 0, 0, -1
        spans: list[tuple[int, int]] = []
        homes, items, since, until = set(), set(), 0, 0
        for some in word_lists(raw):
            for w in some:
                i += 1
                c = code(w)
                if c is None:
                    v = n = 0
                    continue
                t = moves[v].get(c)
                if t is None:
                    while v and t is None:
                        v = link[v]
                        t = moves[v].get(c)
                    if t is None:
                        n = 0
                        continue
                    n = length[v] + 1
                else:
                    n += 1
                v = t
                if n >= window:
                    hit = window
                    homes.add(home[v])
                else:
                    hit = 0
                u = near[v]
                while u >= 0:
                    for k, item in self.short[u]:
                        if k <= n:
                            hit = max(hit, k)
                            items.add(item)
                    u = near[link[u]] if link[u] > 0 else -1
                if hit:
                    if i + 1 - hit > until:
                        if until:
                            spans.append((since, until))
                        since = i + 1 - hit
                    else:
                        # a longer window that ends later may start before the open span
                        since = min(since, i + 1 - hit) if until else i + 1 - hit
                        while spans and spans[-1][1] >= since:
                            since = min(since, spans.pop()[0])
                    until = i + 1
        if until:
            spans.append((since, until))
        for u in homes:
            items.update(self.items[u])
        return i + 1, spans, items


_WORD, _GAP = re.compile(WORD.encode()), re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")


def word_lists(raw: bytes | None, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text, in lists of some ``size`` bytes of it."""
    low, at = (raw or b"").lower(), 0              # on bytes, lower() is ASCII only
    while at < len(low):
        gap = _GAP.search(low, at + size)
        stop = gap.start() if gap else len(low)
        yield _WORD.findall(low, at, stop)
        at = stop


def byte_spans(raw: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word spans as [from, to) byte offsets."""
    out, at = [], 0
    for i, m in enumerate(_WORD.finditer(raw.lower())):
        if at == len(spans):
            break
        if i == spans[at][0]:
            out.append([m.start(), 0])
        if i == spans[at][1] - 1:
            out[-1][1] = m.end()
            at += 1
    return [tuple(x) for x in out]


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def item_blocks(items: DataFrame, window: int = 10, id_col: str = "item_id", text_col: str = "text",
                block_words: int = BLOCK_WORDS, piece_words: int = PIECE_WORDS) -> tuple[DataFrame, int]:
    """((item, words, block), number of blocks): pieces of at most ``piece_words``
    window starts, in blocks of at most ``block_words`` words."""
    low = F.translate(F.col(f"`{text_col}`").cast("string"), UPPER, LOWER)
    own = items.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("item"),
                       F.regexp_extract_all(low, F.lit(WORD), 0).alias("words")).where("size(words) > 0")
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0)), F.lit(piece_words))
    pieces = (own.withColumn("at", F.explode(starts))
              .select("item", F.slice("words", F.col("at") + 1, F.lit(piece_words + window - 1)).alias("words")).distinct())
    size = F.size("words") + F.expr("aggregate(words, 0L, (s, w) -> s + octet_length(w))") / 16
    pieces = stage(pieces.select("item", "words", F.xxhash64("item", "words").alias("h"), size.alias("size")), "items")
    blocks = -(-int(pieces.agg(F.sum("size")).first()[0] or 0) // block_words) or 1
    while True:
        dealt = pieces.withColumn("block", F.pmod("h", F.lit(blocks)))
        largest = dealt.groupBy("block").agg(F.sum("size").alias("s"), F.count(F.lit(1)).alias("n")).agg(
            F.max(F.when(F.col("n") > 1, F.col("s")))).first()[0] or 0     # a single piece is the least block
        if largest <= block_words:
            return dealt.select("item", "words", "block"), blocks
        blocks *= 2


def scan(docs: DataFrame, items: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text",
         block_words: int = BLOCK_WORDS, piece_words: int = PIECE_WORDS, bytes_too: bool = False, **item_cols) -> DataFrame:
    """(id, n_words, spans, items) per document: hit spans as [from, to) word
    numbers (with ``bytes_too`` also ``cuts``, in bytes), names of the items."""
    spark = docs.sparkSession
    bounded_batches(spark)
    pieces, blocks = item_blocks(items, window, block_words=block_words, piece_words=piece_words, **item_cols)
    own = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def automaton(block: int) -> Automaton:
        rows = pieces.where(F.col("block") == block).select("item", "words").collect()          # bounded by block_words
        return Automaton(window).build([(r.item, [w.encode() for w in r.words]) for r in rows])

    if blocks == 1:
        return _pass(own, automaton(0), [], bytes_too)
    rows = stage(own.withColumn("key", F.monotonically_increasing_id()), "documents")
    found = [stage(_pass(rows, automaton(b), ["key"], False).where(F.lit(b == 0) | (F.size("spans") > 0)), "hits")
             for b in range(blocks)]
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    together = every.groupBy("key").agg(F.min("id").alias("id"), F.max("n_words").alias("n_words"),
                                        F.flatten(F.collect_list("spans")).alias("spans"),
                                        F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    together = (together.join(rows.select("key", "text"), "key") if bytes_too
                else together.withColumn("text", F.lit(None).cast("string")))
    return _united(together.select("id", "text", "n_words", "spans", "items"), bytes_too)


SPANS = "array<struct<first:int,stop:int>>"


def _frame(columns: dict):
    import pyarrow as pa

    span = pa.list_(pa.struct([("first", pa.int32()), ("stop", pa.int32())]))
    kinds = {"n_words": pa.int64(), "spans": span, "cuts": span, "items": pa.list_(pa.string())}
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(
        [[{"first": a, "stop": b} for a, b in x] for x in c] if n in ("spans", "cuts") else c, kinds[n])
        for n, c in columns.items()], names=list(columns))


def _pass(rows: DataFrame, automaton: Automaton, keep: list[str], bytes_too: bool) -> DataFrame:
    import pyarrow as pa

    shared = rows.sparkSession.sparkContext.broadcast(vars(automaton))     # plain lists and dicts: workers need no package
    window = automaton.window

    def run(batches: Iterator) -> Iterator:
        machine = Automaton(window)
        vars(machine).update(shared.value)
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary()).to_pylist()
            got = [machine.read(t) for t in texts]
            columns = {"id": batch.column(0)} | {c: batch.column(2 + k) for k, c in enumerate(keep)}
            columns |= {"n_words": [g[0] for g in got], "spans": [g[1] for g in got]}
            if bytes_too:
                columns["cuts"] = [byte_spans(t, g[1]) if g[1] else [] for t, g in zip(texts, got)]
            yield _frame(columns | {"items": [sorted(machine.names[i] for i in g[2]) for g in got]})

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ["id", *keep])
    cuts = f"cuts {SPANS}, " if bytes_too else ""
    return rows.mapInArrow(run, f"{kinds}, n_words bigint, spans {SPANS}, {cuts}items array<string>")


def _united(rows: DataFrame, bytes_too: bool) -> DataFrame:
    """Spans of several blocks as one list each."""
    import pyarrow as pa

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary()).to_pylist()
            spans = [united([(s["first"], s["stop"]) for s in x]) for x in batch.column(3).to_pylist()]
            columns = {"id": batch.column(0), "n_words": batch.column(2), "spans": spans}
            if bytes_too:
                columns["cuts"] = [byte_spans(t, s) if s else [] for t, s in zip(texts, spans)]
            yield _frame(columns | {"items": batch.column(4)})

    cuts = f"cuts {SPANS}, " if bytes_too else ""
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n_words bigint, spans {SPANS}, {cuts}items array<string>")


def hit_words(spans: str = "spans"):
    return F.aggregate(F.transform(spans, lambda s: (s.stop - s.first).cast("long")), F.lit(0).cast("long"), lambda a, b: a + b)


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10, max_share: float = 0.5, id_col: str = "doc_id",
                  text_col: str = "text", **options) -> DataFrame:
    """``docs`` without hit words: spans are cut from the text, and documents of
    which more than ``max_share`` of the words are hit go; all other columns and
    texts without a hit stay as they are."""
    rows = stage(docs.withColumn("__row", F.monotonically_increasing_id()), "documents")
    found = scan(rows, items, window, "__row", text_col, bytes_too=True, **options)
    hits = stage(found.where(F.size("spans") > 0).select(F.col("id").alias("__row"), (hit_words() / F.col("n_words")).alias("__share"),
                                                         F.col("cuts").alias("__cuts")), "hits")
    raw = F.col(f"`{text_col}`").cast("string").cast("binary")
    ends = F.concat(F.array(F.lit(0)), F.transform("__cuts", lambda c: c.stop))
    starts = F.concat(F.transform("__cuts", lambda c: c.first), F.array(F.octet_length(raw)))
    parts = F.transform(F.arrays_zip(ends.alias("a"), starts.alias("b")), lambda p: F.substring(raw, p.a + 1, p.b - p.a).cast("string"))
    text = F.when(F.col("__cuts").isNull(), F.col(f"`{text_col}`")).otherwise(F.array_join(parts, ""))
    kept = rows.join(hits, "__row", "left").where(f"__share is null or __share <= {float(max_share)}")
    return kept.withColumn(text_col, text).select(*[F.col(f"`{c}`") for c in docs.columns])
