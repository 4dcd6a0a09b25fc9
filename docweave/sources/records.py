"""Records of CSV and JSON files that may span lines, read by many tasks per file.

A split of a file does not know whether it starts inside a quoted cell, a string
or a nested value. That depends on counts over everything before it: quotes
(odd: inside a cell or string) and, for JSON, open brackets. So two passes:

1. Every split counts. CSV: its quotes. JSON: its unescaped quotes, and its net
   brackets outside strings for both answers to "does it start in a string?".
   Running sums over one row per split tell every split its start.
2. Every split reads its lines (JSON: the pieces between closing braces) in
   order, starting from that state, and gives out whole records; what belongs to
   a record of an earlier or a later split goes out as a fragment. Fragments, at
   most two a split, are joined by file and place.

Nothing but fragments is shuffled; the broadcast state is 24 bytes per split.
Quotes must be balanced as writers of quoted files leave them: in CSV a cell that
holds a quote is quoted and doubles it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docweave.session import ensure_checkpoint_dir, stage

# what a piece is: a record, or the part of one that the split before began, that goes on, or both
WHOLE, HEAD, TAIL, MIDDLE = range(4)

_ESCAPED = re.compile(r"\\.", re.S)
_STRING = re.compile(r'"[^"]*(?:"|\Z)')


def _pieces(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """(file, block, file_path, value): the pieces of every split, in order."""
    text = spark.read.option("lineSep", separator).text(path)
    return text.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def scan_json_piece(value: str, inside: bool) -> tuple[bool, int]:
    """(inside a string at the end, net brackets outside strings) of a piece."""
    bare = _ESCAPED.sub("", value) if "\\" in value else value
    odd = bare.count('"') % 2 == 1
    out = _STRING.sub("", '"' + bare if inside else bare)
    return inside != odd, out.count("{") + out.count("[") - out.count("]") - out.count("}")


def _json_counts(batches: Iterator) -> Iterator:
    """Per split: parity of quotes, net brackets if it starts outside or inside a
    string, and whether the file is an array (told by its first split). The brace
    that ends a piece counts unless it lies in a string."""
    import pyarrow as pa

    seen: dict = {}
    for batch in batches:
        for file, block, value in zip(*(c.to_pylist() for c in batch.columns)):
            held = seen.get((file, block))
            if held is None:
                held = seen[file, block] = [False, 0, True, 0, block == 0 and value.lstrip("﻿ \t\r\n").startswith("[")]
            for k in (0, 2):
                held[k], net = scan_json_piece(value, held[k])
                held[k + 1] += net - (not held[k])
    rows = [(*key, int(h[0]), h[1], h[3], int(h[4])) for key, h in seen.items()]
    columns = zip(*rows) if rows else [[]] * 6
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["file", "block", "odd", "net0", "net1", "base"])


def _csv_records(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(file, block, kind, first, record) from (file, block, inside, depth, base, line)."""
    at, held, inside, kind, first = None, [], False, TAIL, False
    for file, block, starts_inside, _, _, line in rows:
        if (file, block) != at:
            if held:
                yield (*at, kind, first, "".join(held))
            at, held, inside = (file, block), [], bool(starts_inside)
            kind, first = (MIDDLE, False) if inside else (TAIL, block == 0)
        held.append(line)
        inside ^= line.count('"') % 2 == 1
        if inside:
            held.append("\n")
            continue
        text = "".join(held)
        if text.strip("\r") or kind == MIDDLE:
            yield (*at, WHOLE if kind == TAIL else HEAD, first, text)
            first = False
        held, kind = [], TAIL
    if held:
        yield (*at, kind, first, "".join(held))


def _json_records(rows: Iterator[tuple]) -> Iterator[tuple]:
    at, held, inside, depth, kind = None, [], False, 0, TAIL
    for file, block, starts_inside, starts_at, base, piece in rows:
        if (file, block) != at:
            if held:
                yield (*at, kind, False, "".join(held))
            at, held, inside, depth = (file, block), [], bool(starts_inside), starts_at
            kind = MIDDLE if inside or depth > base else TAIL
        if not held and kind == TAIL:                # between records: only separators before the next brace
            start = piece.find("{")
            if start < 0:
                depth += scan_json_piece(piece, False)[1] - 1
                continue
            depth += scan_json_piece(piece[:start], False)[1]
            piece = piece[start:]
        inside, net = scan_json_piece(piece, inside)
        depth += net - (not inside)
        held += [piece, "}"]
        if not inside and depth <= base:
            yield (*at, WHOLE if kind == TAIL else HEAD, False, "".join(held))
            held, kind = [], TAIL
    if held:
        yield (*at, kind, False, "".join(held))


def _records(pieces: DataFrame, starts: DataFrame, read) -> DataFrame:
    """(file, first, record): ``read`` run over every split from its start state."""
    import pyarrow as pa

    def run(batches: Iterator) -> Iterator:
        rows = (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns)))
        done, size = [], 0
        for out in read(rows):
            done.append(out)
            size += len(out[4])
            if size > 1 << 20 or len(done) == 4096:
                yield frame(done)
                done, size = [], 0
        if done:
            yield frame(done)

    def frame(done: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.string()))],
                                          names=["file", "block", "kind", "first", "record"])

    # one row of five numbers per split
    rows = pieces.join(F.broadcast(starts), ["file", "block"]).select("file", "block", "inside", "depth", "base", "value")
    found = rows.mapInArrow(run, "file bigint, block bigint, kind int, first boolean, record string")
    whole = found.where(F.col("kind") == WHOLE).select("file", "first", "record")
    parts = stage(found.where(F.col("kind") != WHOLE))
    upto = Window.partitionBy("file").orderBy("block", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    chain = parts.withColumn("chain", F.sum((F.col("kind") == TAIL).cast("int")).over(upto))
    texts = F.transform(F.sort_array(F.collect_list(F.struct("block", "kind", "record"))), lambda p: p["record"])
    joined = chain.groupBy("file", "chain").agg(F.bool_or("first").alias("first"), F.array_join(texts, "").alias("record"))
    return whole.unionByName(joined.select("file", "first", "record"))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, first, record): every record of CSV files as text; ``first`` marks
    the first of a file (its header). Blank lines are skipped."""
    lines = _pieces(spark, path, "\n")
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = lines.groupBy("file", "block").agg(F.sum(quotes).alias("n"))
    starts = counts.select("file", "block", ((F.sum("n").over(before) - F.col("n")) % 2).cast("int").alias("inside"),
                           F.lit(0).cast("bigint").alias("depth"), F.lit(0).cast("bigint").alias("base"))
    rows = _records(lines, starts, _csv_records)
    return rows.withColumn("record", F.regexp_replace("record", r"\r\z", ""))


def json_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, first, record): every object of JSON files, be they one array of
    objects or objects one after the other."""
    pieces = _pieces(spark, path, "}")
    counts = pieces.mapInArrow(_json_counts, "file bigint, block bigint, odd bigint, net0 bigint, net1 bigint, base bigint")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    state = counts.withColumn("inside", ((F.sum("odd").over(before) - F.col("odd")) % 2).cast("int"))
    state = state.withColumn("net", F.when(F.col("inside") == 1, F.col("net1")).otherwise(F.col("net0")))
    starts = state.select("file", "block", "inside", (F.sum("net").over(before) - F.col("net")).alias("depth"),
                          F.max("base").over(before).alias("base"))
    return _records(pieces, starts, _json_records)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text; names from the header of the first file."""
    options = {"quote": '"', "escape": '"', "multiLine": "true"}
    names = spark.read.options(header="true", **options).csv(path).schema       # parses one header
    rows = csv_records(spark, path).where("not first")
    columns = ", ".join(f"c{k} string" for k in range(len(names)))
    cells = rows.select(F.from_csv("record", columns, options).alias("r"))
    return cells.select(*[F.col(f"r.c{k}").alias(f.name) for k, f in enumerate(names)])


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """The records as Spark's JSON reader types them. They are written once, one
    to a line (line breaks of a record lie outside its strings), for a reader that
    splits files to infer and parse."""
    import uuid

    lines = f"{ensure_checkpoint_dir(spark).rstrip('/')}/json-records-{uuid.uuid4().hex}"
    json_records(spark, path).select(F.regexp_replace("record", r"[\r\n]+", " ").alias("value")).write.text(lines)
    return spark.read.json(lines)
