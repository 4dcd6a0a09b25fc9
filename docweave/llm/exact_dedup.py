"""Exact dedup: tree-merge of sorted digest runs (DataFrame operations only).

Every input partition reduces its rows to a run of (digest, best row, count).
Runs are then merged in rounds: in each round the runs whose numbers agree
after dropping ``fan_bits`` low bits meet, and every digest keeps its best row
and the sum of its counts. After ceil(log(runs)) rounds one run is left. A
digest meets at most 2**fan_bits partial rows per round, so a text that makes
up a third of the corpus is never a large group anywhere.

A digest is SHA-256 of the normalised text together with its byte length and
an independent 64-bit hash; rows merge only where all three agree, which is
the check against collisions.

Defined results: null text counts as empty; texts are equal when identical
after deleting ASCII white space. Of equal texts the row with the most code
points in the original stays, then the smallest id (null ids last), then the
smallest raw text hash. Fully repeated rows count one by one and one of them
stays. An empty table gives no rows. Other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.common import ASCII_SPACE, keep_rows, stage, text_hash

KEY = ["digest", "check", "n_bytes"]


def digest_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, raw, digest, check, n_bytes, n_chars, run), one row per input row."""
    text = F.col(f"`{text_col}`")
    return (docs.select(F.col(f"`{id_col}`").alias("id"), text_hash(text).alias("raw"),
                        F.char_length(F.coalesce(text, F.lit(""))).alias("n_chars"),
                        F.regexp_replace(F.coalesce(text, F.lit("")), f"{ASCII_SPACE}+", "").alias("norm"))
            .select("id", "raw", "n_chars", F.sha2("norm", 256).alias("digest"), F.xxhash64("norm").alias("check"),
                    F.octet_length("norm").alias("n_bytes"), F.spark_partition_id().alias("run")))


def merge_runs(rows: DataFrame, fan_bits: int = 4) -> DataFrame:
    """(digest, check, n_bytes, best, group_size): the root of the merge tree."""
    best = F.struct((-F.col("n_chars")).alias("neg_chars"), F.col("id").isNull().alias("no_id"),
                    F.col("id").alias("id"), F.col("raw").alias("raw"))
    runs = rows.groupBy("run", *KEY).agg(F.min(best).alias("best"), F.count(F.lit(1)).alias("group_size"))
    left = int(rows.agg(F.max("run")).first()[0] or 0) + 1
    while left > 1:
        runs = (runs.groupBy(F.shiftright("run", fan_bits).alias("run"), *KEY)
                .agg(F.min("best").alias("best"), F.sum("group_size").alias("group_size")))
        left = (left + (1 << fan_bits) - 1) >> fan_bits
    return runs.drop("run")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     fan_bits: int = 4) -> DataFrame:
    """(id, raw, copies, copy, keep_id, group_size, kept, text_sha256), one row
    per input row; ``copies`` counts fully equal (id, text) rows."""
    rows = stage(digest_rows(docs, id_col, text_col), "digests")
    root = merge_runs(rows, fan_bits)
    each = rows.groupBy("id", "raw", "n_chars", *KEY).agg(F.count(F.lit(1)).alias("copies"))
    return (each.join(root, KEY)
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
            .select("id", "raw", "copies", "copy", F.col("best.id").alias("keep_id"), "group_size",
                    ((F.col("copy") == 1) & F.col("id").eqNullSafe(F.col("best.id"))
                     & (F.col("raw") == F.col("best.raw"))).alias("kept"),
                    F.col("digest").alias("text_sha256")))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text another kept row holds."""
    kept = (exact_duplicates(docs, id_col, text_col).where("kept")
            .select(F.col("id").alias("__id"), F.col("raw").alias("__raw"), F.col("copies").alias("__copies")))
    return keep_rows(docs, kept, id_col, text_col)
