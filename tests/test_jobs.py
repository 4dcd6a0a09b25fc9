"""Stage 2 and stage 3 jobs end to end on a small hand-made dataset."""
import json

from pyspark.sql import functions as F

from docweave.plans.jobs import complete_job, enrich_job

AS_OF = "2024-06-01 00:00:00"


def test_enrich_then_complete(spark, tmp_path):
    emb = spark.createDataFrame([
        (1, 100, "ctx one", json.dumps({"lang": "en", "question": "Q1?"}), "add to batch", None, None, None),
        (2, 100, "ctx two", None, "add to batch", None, 7, 3),
        (3, 200, "ctx three", json.dumps({"keywords": ["old"]}), "add to batch", None, 0, None),
    ], "id long, content_id_id long, context string, metadata string, status string, batch_id_id long, "
       "link_id_id long, file_id_id long")
    emb = (emb.withColumn("embedding", F.lit(None).cast("array<float>"))
           .withColumn("updated_at", F.lit(None).cast("timestamp"))
           .withColumn("product_id_id", F.lit(None).cast("long")).withColumn("place_id_id", F.lit(None).cast("long")))
    content = spark.createDataFrame([(100, json.dumps({"src": "a"}), False, "active"), (200, None, False, "active")],
                                    "id long, metadata string, is_complete boolean, status string") \
        .withColumn("updated_at", F.lit(None).cast("timestamp"))
    tag_table = spark.createDataFrame([(1, "big-data", "Big Data")], "id long, key string, name string") \
        .withColumn("created_at", F.lit(None).cast("timestamp")).withColumn("updated_at", F.lit(None).cast("timestamp"))
    content_tags = spark.createDataFrame([(100, 1)], "content_id long, tag_id long")
    batches = spark.createDataFrame([(5, "ext-5", "embeddings", False)],
                                    "id long, batch_id string, type string, is_complete boolean") \
        .withColumn("created_at", F.lit(None).cast("timestamp")).withColumn("updated_at", F.lit(None).cast("timestamp"))
    responses = spark.createDataFrame([
        (1, json.dumps({"content": "R1", "questions": "A? B?", "keywords": ["Big Data", "new one"]})),
        (2, json.dumps({"keywords": {"Dict Key": 1}})),
        (9, json.dumps({"content": "unknown id"})),
        (1, json.dumps({"content": "an earlier line for the same id"})),
    ], "embedding_id long, response string").withColumn("line_order", F.expr("CASE WHEN response LIKE '%earlier%' THEN 0 ELSE embedding_id END"))
    out = enrich_job(responses, emb, content, tag_table, content_tags, batches,
                     spark.createDataFrame([(5,)], "id long"), AS_OF, batch_size=1)

    e = {r.id: r for r in out.embeddings.collect()}
    assert e[1].context.startswith("Question: Q1?\nctx one\n\nMetadata:\nLang: en; Question: Q1?; \n\n\n\n")
    assert "Rephrased Content: R1\n" in e[1].context and e[1].context.endswith("Keywords: Big Data new one")
    assert json.loads(e[1].metadata)["questions"] == ["A?", "B?"]
    assert e[2].context == "ctx two\n\nKeywords: Dict Key"
    assert e[3].status == "add to batch" and e[3].context == "ctx three"           # no response: unchanged
    assert {e[1].status, e[2].status} == {"embedding content"}
    assert e[1].batch_id_id != e[2].batch_id_id                                     # batch size 1

    assert sorted(r.key for r in out.new_tags.collect()) == ["dict-key", "new-one"]
    assert out.embedding_tags.count() == 3
    b = {r.id: r for r in out.batches.collect()}
    assert b[5].is_complete and sum(not r.is_complete for r in b.values()) == 2
    c = {r.id: json.loads(r.metadata) if r.metadata else None for r in out.content.collect()}
    assert c[100]["src"] == "a" and sorted(c[100]["keywords"]) == ["Big Data", "Dict Key", "new one"]
    assert sorted((r.content_id, r.tag_id) for r in out.content_tags.collect())[0][0] == 100
    assert [json.loads(r.line)["custom_id"] for r in out.requests.orderBy("id").collect()] == ["request-1", "request-2"]
    assert [r.detail for r in out.quarantine.collect()] == ["9"]

    # stage 3: vectors for embeddings 1 and 2 arrive
    vectors = spark.createDataFrame([(1, [0.1, 0.2], 3), (2, [0.3, 0.4], 2), (1, [9.0, 9.0], 1), (1, [8.0, 8.0], None)],
                                    "id long, embedding array<float>, line_order int") \
        .withColumn("status", F.lit("complete")).withColumn("updated_at", F.lit(AS_OF).cast("timestamp"))
    links = spark.createDataFrame([(7, "pending"), (8, "pending")], "id long, status string")
    file_table = spark.createDataFrame([(3, "pending")], "id long, status string")
    done = complete_job(vectors, out.embeddings, out.batches, spark.createDataFrame([(5,)], "id long"),
                        content, links, file_table, AS_OF)
    assert {r.id: r.is_complete for r in done.content.collect()} == {100: True, 200: False}
    assert {r.id: r.embedding and [round(x, 1) for x in r.embedding] for r in done.embeddings.collect()} == {1: [0.1, 0.2], 2: [0.3, 0.4], 3: None}
    assert {r.id: r.status for r in done.links.collect()} == {7: "Processed", 8: "pending"}
    assert {r.id: r.status for r in done.files.collect()} == {3: "Processed"}
    strict = complete_job(vectors, out.embeddings, out.batches, spark.createDataFrame([(5,)], "id long"),
                          content, links, file_table, AS_OF, strict=True)
    assert {r.id: r.is_complete for r in strict.content.collect()} == {100: True, 200: False}

    # every output can be written as a table version
    from docweave.plans.jobs import read_table, write_outputs
    write_outputs(out, str(tmp_path / "enrich"))
    write_outputs(done, str(tmp_path / "complete"))
    assert read_table(spark, str(tmp_path / "enrich"), "embeddings").count() == 3
    assert read_table(spark, str(tmp_path / "complete"), "content").where("is_complete").count() == 1
