"""Mixing sources to target weights: a low-discrepancy schedule (DataFrame
operations only).

The documents of a source, in an order shuffled by a hash of the id, form a
line of words that may be read up to ``cap`` times; the line is cut in blocks
of equal word count. Slot n of the mix draws its source by mapping the n-th van
der Corput point (base 2) through the cumulative target shares; the r-th slot
of a source takes that source's block r. Any prefix of the mix is therefore
close to the target shares, and the counts are off by O(log slots) blocks.

Targets: sources by code point order, null last, weigh 1, 2, 3, repeating, and
share all words; a target stops at ``cap`` times its source's words and the
excess is reshared by weight until none is above (solved in closed form: with
sources sorted by cap/weight, the common level is the largest of
(rest of words) / (rest of weights)).

Defined results: size is the number of ASCII-space separated words, null text
0; documents without words are returned with taken 0; repeated rows are rows
of their own; an empty table gives no rows; no words at all give targets 0.
The tables of sources (one row per source) are the only ones ordered in a
single task. Other columns are never read.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docweave.llm.common import ASCII_WORD, prefix_sums, stage, text_hash

#: words of a block at most; a mix has about ``SLOTS`` blocks at least, so small corpora get small blocks
BLOCK_WORDS = 4096
SLOTS = 65536
#: cells that turn "point in interval" into an equality join
CELLS = 4096


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    text = F.col(f"`{text_col}`")
    return docs.select(F.col(f"`{id_col}`").alias("id"), text_hash(text).alias("raw"),
                       F.col(f"`{source_col}`").alias("source"),
                       F.coalesce(F.regexp_count(text, F.lit(ASCII_WORD)), F.lit(0)).cast("long").alias("size"))


def targets(rows: DataFrame, weights: tuple = (1, 2, 3), cap: int = 3) -> DataFrame:
    """(source, src_no, source_size, target, lo, hi): one row per source;
    [lo, hi) is its part of the unit interval."""
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    by_level = Window.orderBy("level", "src_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.partitionBy()
    table = F.array(*[F.lit(float(w)) for w in weights])
    s = (rows.groupBy("source").agg(F.sum("size").alias("source_size"))
         .withColumn("src_no", F.row_number().over(ordered) - 1)
         .withColumn("w", F.element_at(table, (F.col("src_no") % len(weights) + 1).cast("int")))
         .withColumn("most", F.col("source_size") * F.lit(float(cap)))
         .withColumn("level", F.col("most") / F.col("w"))
         .withColumn("share_level", (F.sum("source_size").over(every) - (F.sum("most").over(by_level) - F.col("most")))
                     / (F.sum("w").over(every) - (F.sum("w").over(by_level) - F.col("w"))))
         .withColumn("target", F.least("most", F.max("share_level").over(every) * F.col("w"))))
    line = Window.orderBy("src_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (s.withColumn("part", F.coalesce(F.try_divide(F.sum("target").over(line), F.sum("target").over(every)), F.lit(0.0)))
            .withColumn("lo", F.lag("part", 1, 0.0).over(Window.orderBy("src_no")))
            .withColumn("hi", F.when(F.lead("part").over(Window.orderBy("src_no")).isNull(), F.lit(2.0)).otherwise(F.col("part")))
            .select("source", "src_no", "source_size", "target", "lo", "hi"))


def schedule(spark, parts: DataFrame, slots: int) -> DataFrame:
    """(slot, src_no, rank): the source of every slot and its rank there."""
    point = F.conv(F.reverse(F.lpad(F.bin("slot"), 62, "0")), 2, 10).cast("double") / F.lit(float(2**62))
    cell = parts.where("hi > lo").select(
        "src_no", "lo", "hi",
        F.explode(F.sequence(F.floor(F.col("lo") * CELLS), F.least(F.floor(F.col("hi") * CELLS), F.lit(CELLS - 1)))).alias("cell"))
    drawn = (spark.range(slots).withColumnRenamed("id", "slot").withColumn("x", point)
             .withColumn("cell", F.floor(F.col("x") * CELLS))
             .join(cell, "cell").where("x >= lo and x < hi")
             .select("slot", "src_no", F.floor(F.col("slot") / (math.isqrt(slots) + 1)).alias("chunk"), F.lit(1).cast("long").alias("one")))
    return prefix_sums(drawn, ["src_no"], "chunk", ["slot"], "one", "rank").select("slot", "src_no", "rank")


def mix(docs: DataFrame, weights: tuple = (1, 2, 3), cap: int = 3, block_words: int = BLOCK_WORDS,
        least_slots: int = SLOTS, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """Returns (documents, pieces).

    documents: (id, raw, source, size, source_size, target, taken), one row
    per input row. pieces: (slot, src_no, id, start, length), the mix itself: slot
    order, and the words of each document that the slot reads."""
    spark = docs.sparkSession
    rows = stage(sized(docs, id_col, text_col, source_col), "sizes")
    n, words = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    parts = stage(targets(rows, weights, cap), "sources")
    block = max(1, min(block_words, words // least_slots))
    slots = schedule(spark, parts, -(-words // block))

    buckets = math.isqrt(n) + 1      # prefix sums inside a bucket and over the buckets are then equally long
    shuffled = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))))
    layout = (rows.join(parts.select(F.col("source").alias("s"), "src_no", "source_size", "target"),
                        F.col("source").eqNullSafe(F.col("s"))).drop("s")
              .withColumn("h", shuffled)
              .withColumn("bucket", F.floor(F.conv(F.substring("h", 1, 8), 16, 10).cast("double") / F.lit(float(2**32)) * buckets)))
    layout = stage(prefix_sums(layout, ["src_no"], "bucket", ["h", "id", "raw", "size"], "size", "at"), "layout")

    start = F.col("at") + F.col("epoch") * F.col("source_size")
    read = (layout.where("size > 0")
            .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(cap - 1))))
            .withColumn("start", start).withColumn("end", start + F.col("size"))
            .withColumn("rank", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("end") - 1) / block)))))
    overlap = F.least("end", (F.col("rank") + 1) * block) - F.greatest("start", F.col("rank") * block)
    # sized as before the two explodes, these rows would be broadcast: a merge, and so where every document is a row
    read = read.withColumn("length", overlap).hint("merge").join(slots, ["src_no", "rank"])
    pieces = read.select("slot", "src_no", "id", (F.greatest("start", F.col("rank") * block) - F.col("start")).alias("start"), "length")
    taken = read.groupBy("src_no", F.col("at").alias("spot")).agg(F.sum("length").alias("taken"))
    documents = (layout.withColumn("spot", F.when(F.col("size") > 0, F.col("at"))).hint("merge")
                 .join(taken, ["src_no", "spot"], "left")
                 .select("id", "raw", "source", "size", "source_size", "target",
                         F.coalesce("taken", F.lit(0).cast("long")).alias("taken")))
    return documents, pieces


def repeat_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                     **options) -> DataFrame:
    """``docs`` with every document as often as the mix reads it: taken / size
    rounded half up (0: it goes). Equal rows share their copies evenly."""
    documents, _ = mix(docs, id_col=id_col, text_col=text_col, source_col=source_col, **options)
    times = (documents.where("taken > 0").groupBy("id", "raw", "source")
             .agg(F.floor(F.sum(F.col("taken") / F.col("size")) / F.count(F.lit(1)) + 0.5).alias("__times"))
             .where("__times > 0").alias("t"))
    d = docs.alias("d")
    return (d.join(times, F.col(f"d.`{id_col}`").eqNullSafe(F.col("t.id"))
                   & (text_hash(F.col(f"d.`{text_col}`")) == F.col("t.raw"))
                   & F.col(f"d.`{source_col}`").eqNullSafe(F.col("t.source")))
            .withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("t.__times"))))
            .select(*[F.col(f"d.`{c}`") for c in docs.columns]))
