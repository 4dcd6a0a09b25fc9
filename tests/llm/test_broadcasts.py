"""Spark sizes rows after an explode as those before it: such rows must not be broadcast."""

import re

import pytest
from pyspark.sql import functions as F

from docweave.llm import mixing, simhash


@pytest.fixture(autouse=True)
def default_threshold(spark):
    """Spark's own limit for broadcasts."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.unset(key)
    assert spark.conf.get(key) in ("10485760b", "10MB")
    yield


def broadcast_explodes(df):
    """Names of the exploded columns under any broadcast, in the plan as made and, once it ran, as it ended."""
    found, above = set(), []           # above: depths of the broadcasts around a line
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = re.match(r"[\s:+\-]*", line).end()
        above = [d for d in above if d < depth]
        if line[depth:].startswith("BroadcastExchange"):
            above.append(depth)
        if above and "Generate explode" in line:
            found |= set(re.findall(r"\[(\w+)#\d+L?\]$", line.strip())) or {line}
    return found


def test_the_helper_sees_a_broadcast_explode(spark):
    df = spark.range(100).withColumn("many", F.explode(F.sequence(F.lit(1), F.lit(500))))
    joined = spark.range(10**7).join(df, "id")
    assert broadcast_explodes(joined) == {"many"}
    assert broadcast_explodes(spark.range(10**7).join(df.hint("merge"), "id")) == set()


@pytest.mark.parametrize("cap", [2, 10_000])
def test_variants_of_fingerprints_are_not_broadcast(spark, cap):
    fps = spark.range(300).select(F.col("id").alias("fp"))
    edges = simhash.links(fps, bucket_cap=cap)
    assert broadcast_explodes(edges) == set()
    rows = {tuple(sorted((e.a, e.b))) for e in edges.collect()}
    want = {(i, j) for j in range(300) for i in range(j) if (i ^ j).bit_count() <= 2}
    assert rows <= want and (cap == 2 or rows == want)
    assert broadcast_explodes(edges) == set()


def test_blocks_read_of_documents_are_not_broadcast(spark):
    """Only the 4,096 cells of the schedule may be."""
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), F.col("id").cast("int")).alias("text"),
                                   F.concat(F.lit("s"), F.col("id") % 4).alias("source"))
    documents, pieces = mixing.mix(docs, block_words=16)
    for df in (documents, pieces, documents.where("taken > 0")):
        assert broadcast_explodes(df) <= {"cell"}
        df.collect()
        assert broadcast_explodes(df) <= {"cell"}
    assert pieces.agg(F.sum("length")).first()[0] == documents.agg(F.sum("taken")).first()[0]
