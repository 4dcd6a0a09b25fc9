"""Hot keys of E5, E6, A10: same rows as the plain join, no task with the key alone."""
import pytest
from pyspark.sql import functions as F

from docweave.operators import skew, tables, tags


@pytest.fixture
def no_help(spark):
    """Neither AQE nor a broadcast may hide a hot key."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def largest_share(joined, hot):
    """Rows of the hot key in its fullest task, over all rows of that key."""
    sizes = [r["count"] for r in joined.where(hot).groupBy(F.spark_partition_id()).count().collect()]
    return max(sizes) / sum(sizes)


def hot_rows(spark, n=6000, key_type="bigint"):
    return spark.range(n).select("id", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 11 == 0, None)
                                 .otherwise(100 + F.col("id") % 2000).cast(key_type).alias("k"))


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("key_type, lookup_type", [("bigint", "bigint"), ("int", "bigint"), ("string", "string"), ("string", "bigint")])
def test_same_rows_as_the_plain_join(spark, how, key_type, lookup_type):
    rows = hot_rows(spark, key_type=key_type)
    lookup = spark.range(0, 1500).select(F.col("id").cast(lookup_type).alias("k"), (F.col("id") * 2).alias("v"))
    lookup = lookup.unionByName(spark.createDataFrame([(None, 5)], f"k {lookup_type}, v long"))
    want = sorted(rows.join(lookup, "k", how).select("id", "v").collect(), key=str)
    assert sorted(skew.join_unique(rows, lookup, "k", ["id"], how).select("id", "v").collect(), key=str) == want
    assert skew.join_unique(rows.limit(0), lookup, "k", ["id"], how).count() == 0


def test_heavy_hashes_are_counted_and_bounded(spark):
    rows = hot_rows(spark)
    want = {r.h for r in rows.groupBy("k").count().where("count > 6000 / 256").select(F.xxhash64("k").alias("h")).collect()}
    assert set(skew.heavy_hashes(rows, "k")) == want and len(want) == 2      # the key 7 and null
    assert len(skew.heavy_hashes(spark.range(5000).select((F.col("id") % 300).alias("k")), "k", parts=299)) <= 299


def test_a_hot_keyword_is_dealt_over_tasks(spark, no_help):
    exploded = spark.range(8000).select(F.col("id").alias("embedding_id"),
                                        F.when(F.col("id") % 3 == 0, "Hot Word").otherwise(F.concat(F.lit("w"), F.col("id"))).alias("keyword"))
    ids = exploded.select(F.regexp_replace(F.lower("keyword"), " ", "-").alias("key")).distinct()
    ids = ids.select("key", F.when(F.col("key") == "hot-word", 1).otherwise(F.abs(F.xxhash64("key"))).alias("tag_id"))
    pairs = tags.embedding_tag_pairs(exploded, ids)
    assert pairs.count() == 8000 and pairs.select("embedding_id").distinct().count() == 8000
    assert largest_share(pairs, F.col("tag_id") == 1) < 0.5
    plain = exploded.withColumn("key", F.regexp_replace(F.lower("keyword"), " ", "-")).join(ids, "key")
    assert largest_share(plain, F.col("tag_id") == 1) == 1


def test_a_hot_content_is_dealt_over_tasks(spark, no_help):
    target = hot_rows(spark).select("id", F.col("k").alias("content_id_id"), F.lit("old").alias("status"))
    values = spark.range(0, 1500).select(F.col("id").alias("content_id_id"), F.concat(F.lit("new"), F.col("id")).alias("status"))
    got = tables.update_by_content(target, values, unique=True)
    assert got.columns == target.columns and got.count() == 6000
    assert got.where("content_id_id = 7 and status <> 'new7'").count() == 0
    assert got.where("(content_id_id is null or content_id_id >= 1500) and status <> 'old'").count() == 0
    assert largest_share(got, F.col("content_id_id") == 7) < 0.5
