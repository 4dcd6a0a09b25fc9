"""Packing: concatenate and cut.

Pass 1 tokenizes every document once, adds the end id, and keeps a running
token offset inside each partition; the rows are written to the shared folder.
Partition totals then give every partition its global offset (a prefix sum over
one row per partition). Pass 2 cuts the global token line into windows of
``length`` ids: a document lies in windows offset // length up to
(offset + n - 1) // length, and each of these is one boundary record. Only the
last window can be short, so padding is below one window for the whole corpus.

Tokenizing: the vocabulary file lower-cases, drops white space, and no id spans
it, so the ids of a text are those of its lower-case blank-separated pieces in
order. Each worker encodes a piece the first time it sees it and keeps the ids
(a bounded memo). ``whole_text=True`` encodes whole texts instead, for other
tokenizers.

Defined results: null text counts as empty (its only id is the end id); equal
rows are documents of their own; an empty table gives no rows. Only the id and
text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docweave.llm.common import bounded_batches, stage, worker_cache

#: pieces a worker keeps in its memo before it starts anew
MEMO_PIECES = 400_000


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable
    Latin-1 stands for itself, the rest follow from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


def _encoder(vocab_path: str, whole_text: bool):
    """bytes of a text -> bytes of its ids (unsigned 32 bit, little endian)."""
    import os
    import re
    from array import array

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    cache = worker_cache(f"tokenizer:{vocab_path}")
    if "tokenizer" not in cache:
        from tokenizers import Tokenizer

        cache["tokenizer"], cache["memo"] = Tokenizer.from_file(vocab_path), {}
    tokenizer, memo = cache["tokenizer"], cache["memo"]
    word, letters = re.compile("([a-z\u00e0-\u00f6\u00f8-\u00ff]+)([.,]?)").fullmatch, _byte_letters()

    def pack_ids(ids: list[int]) -> bytes:
        return array("I", ids).tobytes()

    def whole(raw: bytes) -> bytes:
        return pack_ids(tokenizer.encode(raw.decode("utf-8", "replace"), add_special_tokens=False).ids)

    if whole_text:
        return whole
    model = tokenizer.model
    ends = {mark: whole(mark.encode()) for mark in ".,"} | {"": b""}

    def piece_ids(p: bytes) -> bytes:
        """A word of Latin-1 letters, with at most one full stop or comma after
        it, is one or two pre-tokens that normalisation only lower-cases: the
        vocabulary's merges are applied at once. Anything else is encoded in full."""
        text = p.decode("utf-8", "replace")
        if found := word(text.lower()):
            name = found[1]
            spelt = name if name.isascii() else "".join([letters[b] for b in name.encode()])
            return pack_ids([t.id for t in model.tokenize(spelt)]) + ends[found[2]]
        return whole(p)

    def by_piece(raw: bytes) -> bytes:
        if b"<|" in raw:              # strings of special tokens are matched as they are written
            return whole(raw)
        pieces = raw.lower().split()  # both touch ASCII only
        try:
            return b"".join([memo[p] for p in pieces])
        except KeyError:
            pass
        new = {p for p in pieces if p not in memo}
        if len(memo) + len(new) > MEMO_PIECES:
            memo.clear()
            new = set(pieces)
        for p in new:
            memo[p] = piece_ids(p)
        return b"".join([memo[p] for p in pieces])

    return by_piece


def tokenize(docs: DataFrame, vocab_path: str, end_id: int, id_col: str, text_col: str,
             whole_text: bool = False) -> DataFrame:
    """(id, part, at, n, ids): ids as bytes, ``at`` the token offset inside
    partition ``part``."""
    import pyarrow as pa

    def run(batches: Iterator) -> Iterator:
        from pyspark import TaskContext

        encode = _encoder(vocab_path, whole_text)
        end, part, at = int(end_id).to_bytes(4, "little"), TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary()).to_pylist()
            ids = [encode(t) + end if t else end for t in texts]
            n = [len(x) // 4 for x in ids]
            starts = []
            for x in n:
                starts.append(at)
                at += x
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([part] * len(n), pa.int32()), pa.array(starts, pa.int64()),
                 pa.array(n, pa.int64()), pa.array(ids, pa.binary())], names=["id", "part", "at", "n", "ids"])

    bounded_batches(docs.sparkSession)
    own = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = own.schema["id"].dataType.simpleString()
    return own.mapInArrow(run, f"id {kind}, part int, at bigint, n bigint, ids binary")


def pack(docs: DataFrame, vocab_path: str, length: int = 4096, end_id: int = 2, id_col: str = "doc_id",
         text_col: str = "text", whole_text: bool = False) -> DataFrame:
    """(id, start, length, ids, doc_tokens, sequence_id, offset), one row per
    piece of a document inside one sequence; ids are the bytes of the piece."""
    rows = stage(tokenize(docs, vocab_path, end_id, id_col, text_col, whole_text), "tokens")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = rows.groupBy("part").agg(F.sum("n").alias("total"))
    offsets = totals.select("part", (F.sum("total").over(before) - F.col("total")).alias("base"))
    # one row of 16 bytes per input partition
    placed = rows.join(F.broadcast(offsets), "part").withColumn("g", F.col("base") + F.col("at"))
    cut = placed.withColumn("sequence_id", F.explode(F.sequence(
        F.floor(F.col("g") / length), F.floor((F.col("g") + F.col("n") - 1) / length))))
    first = F.greatest("g", F.col("sequence_id") * length)
    last = F.least(F.col("g") + F.col("n"), (F.col("sequence_id") + 1) * length)
    return (cut.withColumn("start", first - F.col("g")).withColumn("length", last - first)
            .select("id", "start", "length",
                    F.substring("ids", (F.col("start") * 4 + 1).cast("int"), (F.col("length") * 4).cast("int")).alias("ids"),
                    F.col("n").alias("doc_tokens"), "sequence_id",
                    (F.col("start") + F.col("g") - F.col("sequence_id") * length).alias("offset")))
