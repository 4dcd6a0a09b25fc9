"""E1 numbering and batches, A8 ids, A9 last wins, A11, tags get-or-create, F1."""
from pyspark.sql import functions as F

from docweave.operators import lifecycle, tables, tags


def test_batches_sizes(spark):
    for n, sizes in [(0, []), (1, [1]), (999, [999]), (1000, [1000]), (1001, [1000, 1]),
                     (2500, [1000, 1000, 500])]:
        df = spark.range(n).select((F.col("id") * 7 + 3).alias("id"))
        got = tables.assign_batches(df, ["id"], 1000).groupBy("batch_no").count().orderBy("batch_no").collect()
        assert [r["count"] for r in got] == sizes
        assert [r.batch_no for r in got] == list(range(len(sizes)))


def test_row_index_is_dense_and_ordered(spark):
    df = spark.range(5000).select(((F.col("id") * 7919) % 5003).alias("k"), (F.col("id") % 3).alias("g"))
    rows = tables.with_row_index(df, ["g", "k"], "i", num_partitions=7).collect()
    ordered = sorted(rows, key=lambda r: (r.g, r.k))
    assert [r.i for r in ordered] == list(range(5000))


def test_row_index_skewed_key(spark):
    # a third of the rows share the first key column
    df = spark.range(3000).select(F.when(F.col("id") < 1000, 0).otherwise(F.col("id")).alias("a"), "id")
    rows = tables.with_row_index(df, ["a", "id"], "i", num_partitions=6).collect()
    assert sorted(r.i for r in rows) == list(range(3000))
    assert [r.i for r in sorted(rows, key=lambda r: (r.a, r.id))] == list(range(3000))


def test_update_last_wins(spark):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, "c", 30)], "id long, name string, v int")
    updates = spark.createDataFrame([(2, 1, "x", 1), (2, 3, "z", 3), (2, 2, "y", 2), (9, 1, "q", 9)],
                                    "id long, ord int, name string, v int")
    got = sorted(tuple(r) for r in tables.update_by_key(target, updates, order_col="ord").collect())
    assert got == [(1, "a", 10), (2, "z", 3), (3, "c", 30)]
    empty = updates.limit(0)
    assert sorted(tuple(r) for r in tables.update_by_key(target, empty, order_col="ord").collect()) == \
        [(1, "a", 10), (2, "b", 20), (3, "c", 30)]


def test_append_and_delete(spark):
    target = spark.createDataFrame([(4, "a"), (9, "b")], "id long, name string")
    rows = spark.createDataFrame([("z",), ("c",)], "name string")
    got = sorted(tuple(r) for r in tables.append_rows(target, rows, ["name"]).collect())
    assert got == [(4, "a"), (9, "b"), (10, "c"), (11, "z")]
    ids = spark.createDataFrame([(9,), (100,)], "x long")
    assert [r.id for r in tables.delete_by_ids(target, ids).collect()] == [4]


def test_tags_get_or_create(spark):
    existing = spark.createDataFrame([(1, "big-data", "Big Data")], "id long, key string, name string")
    kw = spark.createDataFrame([(1, "Big Data"), (1, "big data"), (2, "New tag"), (3, "new tag")],
                               "embedding_id long, keyword string")
    created, ids = tags.tags_get_or_create(kw, existing)
    assert [tuple(r) for r in created.select("id", "key", "name").collect()] == [(2, "new-tag", "New Tag")]
    assert sorted(tuple(r) for r in ids.collect()) == [("big-data", 1), ("new-tag", 2)]
    pairs = sorted(tuple(r) for r in tags.embedding_tag_pairs(kw, ids).collect())
    assert pairs == [(1, 1), (1, 1), (2, 2), (3, 2)]        # not deduplicated
    empty_created, _ = tags.tags_get_or_create(kw.limit(0), existing)
    assert empty_created.count() == 0


def test_completed_contents_default_and_strict(spark):
    emb = spark.createDataFrame(
        [(1, 10, "complete"), (2, 10, "complete"), (3, 11, None), (4, 12, "complete"), (5, 12, "embedding content")],
        "id long, content_id_id long, status string")
    ids = spark.createDataFrame([(1,), (3,), (4,)], "id long")
    assert sorted(r.id for r in lifecycle.completed_contents(emb, ids).collect()) == [10, 11, 12]
    assert sorted(r.id for r in lifecycle.completed_contents(emb, ids, strict=True).collect()) == [10, 11]


def test_processed_ids_skip_null_and_zero(spark):
    att = spark.createDataFrame([(None, 1), (0, 2), (5, 2), (5, None)], "file_id long, link_id long")
    assert sorted(r.id for r in lifecycle.processed_ids(att, "file_id").collect()) == [5]
    assert sorted(r.id for r in lifecycle.processed_ids(att, "link_id").collect()) == [1, 2]


def test_row_index_many_ranges(spark):
    # more ranges than the CASE search handles: numeric keys use Bucketizer,
    # other keys are capped; both must number densely in key order
    df = spark.range(20000).select(((F.col("id") * 7919) % 20011).alias("k"), (F.col("id") % 4).alias("g"))
    for keys in (["k"], ["g", "k"]):
        rows = tables.with_row_index(df, keys, "i", num_partitions=400).collect()
        ordered = sorted(rows, key=lambda r: tuple(r[k] for k in keys))
        assert [r.i for r in ordered] == list(range(20000)), keys


def test_types_get_or_create(spark):
    existing = spark.createDataFrame([(3, "web_page", "Web Page")], "id long, key string, name string")
    names = spark.createDataFrame([("Web Page",), ("web page",), ("PDF File",), ("pdf file",), (None,)], "name string")
    created, ids = tags.types_get_or_create(names, existing)
    assert [tuple(r) for r in created.select("id", "key", "name").collect()] == [(4, "pdf_file", "PDF File")]
    assert sorted(tuple(r) for r in ids.collect()) == [("pdf_file", 4), ("web_page", 3)]


def test_numbering_is_deterministic(spark):
    """Recomputing a numbered frame (as after a lost executor) gives the same
    numbers, and independent numberings of the same rows agree."""
    df = spark.range(30000).select(((F.col("id") * 7919) % 30011).alias("k")).repartition(5)
    a = tables.with_row_index(df, ["k"], "i", num_partitions=9)
    first = {r.k: r.i for r in a.collect()}
    again = {r.k: r.i for r in a.collect()}
    other = {r.k: r.i for r in tables.with_row_index(df, ["k"], "i", num_partitions=4).collect()}
    assert first == again == other


def test_null_order_is_the_earliest_and_order_is_required(spark):
    import pytest

    target = spark.createDataFrame([(1, "old"), (2, "old"), (3, "old")], "id long, v string")
    updates = spark.createDataFrame([(1, None, "new"), (2, None, "lost"), (2, 0, "new"), (3, 1, None)], "id long, ord int, v string")
    got = sorted(tuple(r) for r in tables.update_by_key(target, updates, order_col="ord").collect())
    assert got == [(1, "new"), (2, "new"), (3, None)]
    with pytest.raises(ValueError):
        tables.update_by_key(target, updates)
    changed = tables.update_by_key(target, updates.where("id < 3"), order_col="ord", changed_only=True)
    assert sorted(tuple(r) for r in changed.collect()) == [(1, "new"), (2, "new")]


def test_numbering_over_many_tasks_and_string_keys(spark):
    """Only one row per range is gathered, whatever the number of input tasks; any key type, any number of ranges."""
    df = spark.range(0, 4000, 1, 450).select(F.md5(F.col("id").cast("string")).alias("k"))
    rows = tables.with_row_index(df, ["k"], "i", num_partitions=300).collect()
    assert [r.i for r in sorted(rows, key=lambda r: r.k)] == list(range(4000))


def test_external_batch_ids_do_not_repeat(spark):
    batches = spark.createDataFrame([(5, "e5", "embeddings", False)], "id long, batch_id string, type string, is_complete boolean")
    assigned = spark.createDataFrame([(1, 0), (2, 1)], "id long, batch_no long")
    first = lifecycle.create_batches(assigned, batches).select(*batches.columns)
    second = lifecycle.create_batches(assigned, batches.unionByName(first)).select(*batches.columns)
    ids = [r.batch_id for r in first.unionByName(second).collect()]
    assert len(ids) == len(set(ids)) == 4


def test_hot_content_is_spread(spark):
    """A content with a third of all rows: every task that joins or aggregates its rows gets a part of them."""
    import json

    from docweave.operators.enrichment import merge_metadata_by_content

    rows = [(i % 3 and i or 0, i, json.dumps({"k": i, "l": [str(i % 5)], "d": {f"x{i % 4}": i}})) for i in range(1, 601)]
    df = spark.createDataFrame(rows, "content_id long, id long, metadata string").repartition(6)
    hot = [r for r in merge_metadata_by_content(df).collect() if r.id == 0]
    last = {f"x{i % 4}": i for i in range(3, 601, 3)}
    assert json.loads(hot[0].metadata) == {"k": 600, "l": ["0", "1", "2", "3", "4"], "d": last}
