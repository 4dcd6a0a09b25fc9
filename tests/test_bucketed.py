"""Bucketed tables: a keyed update shuffles the updates only, version after version."""
import glob

import pytest
from pyspark.sql import functions as F

from docweave.operators import tables
from docweave.sources.bucketed import write_bucketed


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(spark, n=3000):
    return spark.range(n).select("id", F.concat(F.lit("t"), F.col("id")).alias("text"), F.lit("new").alias("status"))


def test_updates_do_not_shuffle_the_table(spark, tmp_path, no_broadcast):
    first = write_bucketed(rows(spark), "emb_v1", buckets=6, path=str(tmp_path / "v1"))
    updates = spark.range(0, 6000, 7).select("id", F.lit(1).alias("ord"), F.lit("done").alias("status"))
    changed = tables.update_by_key(first, updates, order_col="ord")
    text = plan(changed)
    target = text[text.index("SortMergeJoin"):]
    # the one exchange is the aggregation of the updates; the plain table needs one more
    assert target.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in text
    plain = plan(tables.update_by_key(rows(spark).repartition(5), updates, order_col="ord"))
    assert plain.count("Exchange hashpartitioning") == 2
    # the next version is written from the join without an exchange of its own
    assert plan(changed.repartition(6, F.col("id"))).count("Exchange hashpartitioning") == 1
    second = write_bucketed(changed, "emb_v2", buckets=6, path=str(tmp_path / "v2"))
    assert len(glob.glob(str(tmp_path / "v2/*.parquet"))) == 6
    want = sorted((i, f"t{i}", "done" if i % 7 == 0 else "new") for i in range(3000))
    assert sorted(tuple(r) for r in second.collect()) == want
    again = tables.update_by_key(second, spark.createDataFrame([(1, "last")], "id long, status string"), unique=True)
    assert plan(again).count("Exchange hashpartitioning") == 1      # the one new row
    assert {tuple(r) for r in again.where("status = 'last'").collect()} == {(1, "t1", "last")}
    for name in ("emb_v1", "emb_v2"):
        spark.sql(f"DROP TABLE {name}")


def test_empty_table_and_null_keys(spark, tmp_path):
    empty = write_bucketed(rows(spark, 0), "emb_empty", buckets=3, path=str(tmp_path / "e"))
    assert empty.count() == 0 and empty.columns == ["id", "text", "status"]
    some = spark.createDataFrame([(None, "a"), (None, "b"), (1, "c")], "id long, text string")
    assert sorted((r.id or 0, r.text) for r in write_bucketed(some, "emb_null", buckets=3, path=str(tmp_path / "n")).collect()) == [(0, "a"), (0, "b"), (1, "c")]
    with pytest.raises(ValueError):
        write_bucketed(some, "emb_none", buckets=0)
    for name in ("emb_empty", "emb_null"):
        spark.sql(f"DROP TABLE {name}")
