"""Helpers shared by the operators: staged tables in the shared folder, rows
kept by key, connected components, exact two-level prefix sums."""

from __future__ import annotations

import sys
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docweave.session import ensure_checkpoint_dir

#: the white space of every word and text contract here, as a regular expression class
ASCII_SPACE = r"[\x20\x09-\x0D]"
ASCII_WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under ``spark.checkpoint.dir`` and read it back: cuts
    lineage, and a lost executor costs a re-read, not a recomputation."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession, mb: int = 4, rows: int = 2000) -> None:
    """Cap the bytes and rows of an Arrow batch so that long texts cannot fill a
    Python worker; smaller limits already set by the session stay."""
    for key, most in (("spark.sql.execution.arrow.maxBytesPerBatch", mb << 20), ("spark.sql.execution.arrow.maxRecordsPerBatch", rows)):
        try:
            now = int(spark.conf.get(key))
        except Exception:  # noqa: BLE001 - written with a unit, or unknown to this version
            now = -1
        if now <= 0 or now > most:
            spark.conf.set(key, str(most))


def worker_cache(name: str) -> dict:
    """A dict that lives as long as the Python worker process. Functions reach
    the workers by value, so a module global would start empty in every task."""
    return sys.__dict__.setdefault(f"_docweave_{name}", {})


def text_hash(text: Column) -> Column:
    """Tells rows of one id with different texts apart (null is not empty)."""
    return F.when(text.isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64(text))


def keep_rows(docs: DataFrame, kept: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` named by ``kept`` (``__id``, ``__raw``, ``__copies``,
    unique per id and raw), all columns unchanged. Where the same row occurs
    ``__copies`` > 1 times, one stays; only those rows pay for an aggregation."""
    d, k = docs.alias("d"), kept.alias("k")
    hit = d.join(k, F.col(f"d.`{id_col}`").eqNullSafe(F.col("k.__id"))
                 & (text_hash(F.col(f"d.`{text_col}`")) == F.col("k.__raw")))
    cols = [F.col(f"d.`{c}`") for c in docs.columns]
    once = hit.where("k.__copies = 1").select(*cols)
    more = (hit.where("k.__copies > 1").select(*cols, F.col("k.__raw").alias("__raw"))
            .dropDuplicates([id_col, "__raw"]).drop("__raw"))
    return once.unionByName(more)


def prefix_sums(df: DataFrame, group: list[str], bucket: str, order: list[str], value: str, out: str) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over all earlier rows of the same
    ``group`` in (bucket, order) order. Two passes: sums inside each (group,
    bucket), then one running sum over the bucket totals of a group, so a hot
    group is spread over its buckets. Columns of ``group`` must not be null."""
    inner = Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    outer = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = (df.groupBy(*group, bucket).agg(F.sum(value).alias("__sum"))
              .withColumn("__before", F.sum("__sum").over(outer) - F.col("__sum")).drop("__sum"))
    return (df.withColumn("__inside", F.sum(value).over(inner) - F.col(value))
            .join(totals, [*group, bucket])
            .withColumn(out, F.col("__inside") + F.col("__before")).drop("__inside", "__before"))


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an undirected graph: (node, root), root being
    the smallest node of the component; nodes without edges are absent.

    Alternating large-star and small-star rounds. Every round is a min per node
    (partially aggregated, so a hub collapses before the shuffle) and a join
    back; rounds are written to the shared folder. Only a row count and a sum
    of hashes reach the driver, to see that a round changed nothing."""
    cur = (edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
           .where("hi <> lo").distinct())
    cur = stage(cur, "edges")
    before = _signature(cur)
    while before[0]:
        both = cur.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            cur.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(least, "u").where("v <> m")
                 .select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct())
        least2 = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (large.join(least2, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
                 .unionByName(least2.select("hi", F.col("m").alias("lo"))).distinct())
        cur = stage(small, "edges")
        now = _signature(cur)
        if now == before:
            break
        before = now
    roots = cur.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    return cur.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(roots)
