"""A4 tabular files, A5/A6/A6b result files with bad lines, A7 request lines,
and S1: a stream equals the batch job and a rerun adds nothing."""
import json

import pandas as pd
from pyspark.sql import functions as F

from docweave.plans.jobs import preprocess_job
from docweave.sources import files
from docweave.streaming.jobs import stream_chunks

from conftest import SF0001


def test_read_tabular(spark, tmp_path):
    pd.DataFrame({"a": [1, None], "b": ["x", None]}).to_csv(tmp_path / "t.csv")   # writes "Unnamed: 0"
    df = files.read_tabular(spark, str(tmp_path / "t.csv"), "csv")
    assert df.columns == ["a", "b"]
    assert sorted(tuple(r) for r in df.collect()) == [("", ""), ("1.0", "x")]


def test_enrichment_lines(spark, tmp_path):
    good = {"custom_id": "request-12", "response": {"body": {"choices": [{"message": {
        "content": json.dumps({"content": "c", "keywords": ["k"]})}}]}}}
    lines = [json.dumps(good), "", "not json",
             json.dumps({"custom_id": "request-12-34", "response": good["response"]}),
             json.dumps({"custom_id": "request-x", "response": good["response"]}),
             json.dumps({"custom_id": "request-5", "response": None, "error": {"message": "e"}})]
    (tmp_path / "out.jsonl").write_text("\n".join(lines) + "\n")
    ok, bad = files.read_enrichment_output(spark, str(tmp_path))
    assert sorted(r.embedding_id for r in ok.collect()) == [12, 34]
    assert bad.count() == 3


def test_embedding_lines(spark, tmp_path):
    vec = [0.5, -1.25]
    lines = [json.dumps({"custom_id": "request-7", "response": {"body": {"data": [{"embedding": vec}]}}}),
             json.dumps({"custom_id": "request-8-2", "response": {"body": {"data": [{"embedding": json.dumps(vec)}]}}}),
             json.dumps({"custom_id": "request-9", "response": None, "error": {"message": "x"}})]
    (tmp_path / "v.jsonl").write_text("\n".join(lines))
    ok, bad = files.read_embedding_output(spark, str(tmp_path), "2024-01-01 00:00:00")
    got = sorted((r.id, list(r.embedding), r.status) for r in ok.collect())
    assert got == [(2, vec, "complete"), (7, vec, "complete")]
    assert bad.count() == 1
    ok_t, _ = files.read_embedding_output_table(spark, str(tmp_path))
    assert sorted(r.id for r in ok_t.collect()) == [7, 8]


def test_request_lines_round_trip(spark):
    df = spark.createDataFrame([(1, "héllo\nworld", 0)], "id long, context string, batch_no long")
    line = files.embedding_requests(df).first().line
    assert json.loads(line) == {"custom_id": "request-1", "method": "POST", "url": "/v1/embeddings",
                                "body": {"model": "text-embedding-3-small", "input": "héllo\nworld"}}


def test_stream_chunks_equals_batch_and_replay_is_safe(spark, tmp_path):
    src = tmp_path / "content"
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").selectExpr("doc_id AS id", "text AS content")
    docs.write.parquet(str(src))
    sink, ckpt = str(tmp_path / "sink"), str(tmp_path / "ckpt")
    q = stream_chunks(spark, str(src), docs.schema, sink, ckpt)
    q.awaitTermination()
    streamed = spark.read.parquet(sink)
    batch = preprocess_job(docs)
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch).count() == 0
    q2 = stream_chunks(spark, str(src), docs.schema, sink, ckpt)
    q2.awaitTermination()
    assert spark.read.parquet(sink).count() == batch.count()
    # the same rows under another file name, and one of them with a new text
    import shutil
    shutil.copy(next(src.glob("*.parquet")), src / "again.parquet")
    docs.limit(1).selectExpr("id", "'a new text' AS content").coalesce(1).write.parquet(str(tmp_path / "new"))
    shutil.copy(next((tmp_path / "new").glob("*.parquet")), src / "new.parquet")
    stream_chunks(spark, str(src), docs.schema, sink, ckpt).awaitTermination()
    assert spark.read.parquet(sink).count() == batch.count() + 1


def test_stream_chunks_query_reads_a_table_of_several_files(spark, tmp_path):
    from docweave.plans.catalog import QUERIES

    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    want = preprocess_job(docs.selectExpr("doc_id AS id", "text AS content"))
    docs.repartition(3).write.parquet(str(tmp_path / "many" / "documents.parquet"))
    docs.limit(0).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    for folder in (SF0001, str(tmp_path / "many")):
        got = QUERIES["stream_chunks"](spark, folder)
        assert got.count() == want.count() and got.exceptAll(want).count() == 0
    none = QUERIES["stream_chunks"](spark, str(tmp_path / "none"))
    assert none.dtypes == want.dtypes and none.count() == 0


def _state(spark):
    none = F.lit(None)
    emb = (spark.range(1, 7).selectExpr("id", "100 + id % 2 AS content_id_id", "concat('c', id) AS context", "'{\"a\": 1}' AS metadata",
                                        "'add to batch' AS status", "CAST(NULL AS BIGINT) AS batch_id_id", "6 + id AS link_id_id", "3L AS file_id_id",
                                        "CAST(NULL AS BIGINT) AS product_id_id", "CAST(NULL AS BIGINT) AS place_id_id")
           .withColumn("embedding", none.cast("array<float>")).withColumn("updated_at", none.cast("timestamp")))
    content = spark.createDataFrame([(100, None, False, "active"), (101, '{"src": 1}', False, "active")],
                                    "id long, metadata string, is_complete boolean, status string").withColumn("updated_at", none.cast("timestamp"))
    return {"embeddings": emb, "content": content,
            "tags": spark.createDataFrame([], "id long, key string, name string, created_at timestamp, updated_at timestamp"),
            "content_tags": spark.createDataFrame([], "content_id long, tag_id long"),
            "batches": spark.createDataFrame([(5, "e5", "embeddings", False, None, None)],
                                             "id long, batch_id string, type string, is_complete boolean, created_at timestamp, updated_at timestamp"),
            "links": spark.createDataFrame([(i, "pending") for i in range(7, 14)], "id long, status string"),
            "files": spark.createDataFrame([(3, "pending")], "id long, status string")}


def _chat(i, **content):
    return json.dumps({"custom_id": f"request-{i}", "response": {"body": {"choices": [{"message": {"content": json.dumps(content)}}]}}})


def _vector(i, *v):
    return json.dumps({"custom_id": f"request-{i}", "response": {"body": {"data": [{"embedding": list(v)}]}}})


def _rows(df):
    return sorted(map(str, df.collect()))


def test_streams_carry_state_and_replay(spark, tmp_path):
    """Three epochs of S2 and S3, in one session, equal the batch job over all
    files; a replay of the middle epoch of S2 changes nothing, nor does a restart of S3."""
    import shutil
    import time

    from docweave.plans.jobs import complete_job, enrich_job
    from docweave.streaming import completion
    from docweave.streaming import jobs
    from docweave.streaming.store import EpochTables

    as_of, none = "2024-01-01 00:00:00", spark.createDataFrame([], "id long")
    tables = _state(spark)
    chat, vec = tmp_path / "chat", tmp_path / "vec"
    for folder, files_ in ((chat, [[_chat(1, keywords=["k one", "x"]), "not json"], [_chat(2, keywords=["x"]), _chat(3, content="R")],
                                   [_chat(4, keywords=["new"]), _chat(1, content="second time")]]),
                           (vec, [[_vector(1, 1, 2), _vector(2, 3, 4)], [_vector(3, 5, 6), _vector(4, 7, 8), "{}"], [_vector(6, 9, 9), _vector(2, 0.5, 0.5)]])):
        folder.mkdir()
        for i, lines in enumerate(files_):
            (folder / f"{i}.jsonl").write_text("\n".join(lines))
            time.sleep(1.1)      # the file source takes files in order of time
    s2 = EpochTables(spark, str(tmp_path / "s2"), jobs.ENRICHMENT_TABLES)
    for name in s2.keys:
        s2.create(name, tables[name])
    q2 = jobs.stream_enrichment(spark, str(chat), s2, lambda t: t["batches"].where("id = 5").select("id"), str(tmp_path / "c2"), as_of, max_files_per_trigger=1)
    q2.awaitTermination()
    assert s2.next_epoch() == 3

    vectors, bad = files.read_embedding_output(spark, str(vec), as_of)
    base = [tables[n] for n in ("embeddings", "batches")] + [none] + [tables[n] for n in ("content", "links", "files")]
    want = complete_job(vectors, *base, as_of)
    for strict in (False, True):
        root = str(tmp_path / f"s3-{strict}")
        for _ in range(2):                # the second start finds nothing new
            queries = completion.stream_completion(spark, str(vec), tables["embeddings"], f"{root}/out", f"{root}/ckpt", as_of, strict,
                                                   max_files_per_trigger=1)
            queries[1].awaitTermination()
        got = completion.completion_tables(spark, f"{root}/out", *base)
        for name in ("embeddings", "batches", "links", "files"):
            assert _rows(vars(got)[name].select(*tables[name].columns)) == _rows(vars(want)[name].select(*tables[name].columns)), name
        # a vector arrived for both contents (default F1); 5, the last embedding of content 101, is still open (strict)
        assert {r.id: r.is_complete for r in got.content.collect()} == {100: True, 101: not strict}
        assert completion.bad_lines(spark, f"{root}/out").count() == bad.count() == 1
        assert sorted((r.id, r.version) for r in completion.changes(spark, f"{root}/out").collect()) == [(1, 1), (2, 1), (2, 2), (3, 1), (4, 1), (6, 1)]
    # the missing vector arrives: content 101 is finished, once, and no other row changes
    (vec / "9.jsonl").write_text("\n".join([_vector(5, 1, 1), _vector(77, 1, 1), _vector(5, 2, 2)]))
    for _ in range(2):
        completion.stream_completion(spark, str(vec), tables["embeddings"].limit(0), f"{root}/out", f"{root}/ckpt", as_of)[1].awaitTermination()
    got = completion.completion_tables(spark, f"{root}/out", *base)
    assert sorted(r.id for r in spark.read.parquet(f"{root}/out/contents").collect()) == [100, 101]
    assert {r.id: r.embedding for r in got.embeddings.collect()}[5] == [2.0, 2.0] and completion.changes(spark, f"{root}/out").count() == 7

    emb = {r.id: r for r in s2.read("embeddings").collect()}
    assert len(emb) == 6 and emb[1].context.startswith("c1\n\nMetadata:") and "Rephrased Content: second time" in emb[1].context
    assert emb[5].context == "c5" and emb[5].status == "add to batch"
    assert sorted(r.key for r in s2.read("tags").collect()) == ["k-one", "new", "x"]
    batches = s2.read("batches").collect()
    assert len({r.id for r in batches}) == len({r.batch_id for r in batches}) == len(batches) == 4 and [r.id for r in batches if r.is_complete] == [5]
    assert len({(r.content_id, r.tag_id) for r in s2.read("content_tags").collect()}) == s2.read("content_tags").count() == 4
    first = spark.read.parquet(str(tmp_path / "s2/embedding_tags/epoch=0"))
    assert first.count() == 2

    # replay of epoch 1: it reads what epoch 0 left, though epochs 1 and 2 are there
    before = {name: _rows(s2.read(name)) for name in s2.keys}
    good, _ = files.read_enrichment_output(spark, str(chat / "1.jsonl"))
    state = {name: s2.read(name, before=1) for name in s2.keys}
    again = enrich_job(good, state["embeddings"], state["content"], state["tags"], state["content_tags"], state["batches"],
                       state["batches"].where("id = 5").select("id"), as_of, changed_only=True)
    rows = dict(vars(again))
    rows["tags"] = rows.pop("new_tags")
    s2.write(1, rows)
    assert {name: _rows(s2.read(name)) for name in s2.keys} == before
    # a new base reads the same; an unfinished base does not count
    for name in s2.keys:
        s2.compact(name)
    assert {name: _rows(s2.read(name)) for name in s2.keys} == before
    shutil.copytree(tmp_path / "s2/embeddings/base=0", tmp_path / "s2/embeddings/base=9", ignore=shutil.ignore_patterns("_SUCCESS"))
    assert _rows(s2.read("embeddings")) == before["embeddings"]


def test_last_line_wins_whatever_the_file_sizes(spark, tmp_path):
    from docweave.operators.lifecycle import apply_embeddings

    target = spark.createDataFrame([(1, None, "x"), (2, None, "x")], "id long, embedding array<float>, status string")
    for sizes in ((1, 400), (400, 1)):
        folder = tmp_path / str(sizes[0])
        folder.mkdir()
        for name, n, v in (("a", sizes[0], 1.0), ("b", sizes[1], 2.0)):
            (folder / f"{name}.jsonl").write_text("\n".join([_vector(1, 0.0)] * n + [_vector(1, v)]))
        vectors, _ = files.read_embedding_output(spark, str(folder), "2024-01-01 00:00:00")
        got = {r.id: r.embedding for r in apply_embeddings(target, vectors).collect()}
        assert got == {1: [2.0], 2: None}


def test_bad_ids_go_to_quarantine(spark, tmp_path):
    (tmp_path / "v.jsonl").write_text("\n".join([_vector("99999999999999999999", 1), _vector("", 1), _vector(3, 1)]))
    good, bad = files.read_embedding_output(spark, str(tmp_path), "2024-01-01 00:00:00")
    assert [r.id for r in good.collect()] == [3] and bad.count() == 2


def test_read_tabular_quotes_breaks_and_missing_cells(spark, tmp_path):
    frame = pd.DataFrame({"a": ['say "hi", ok', "line\nbreak", "NA", "null", ""], "b": ["x", "y,z", "n/a", "None", "NaN"]})
    frame.to_csv(tmp_path / "q.csv")
    want = pd.read_csv(tmp_path / "q.csv").fillna("").astype(str)
    got = files.read_tabular(spark, str(tmp_path / "q.csv"), "csv")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want[["a", "b"]].to_numpy()))


def test_read_tabular_json_records(spark, tmp_path):
    pd.DataFrame({"a": [1, 2], "b": ["x", None]}).to_json(tmp_path / "t.json", orient="records")
    df = files.read_tabular(spark, str(tmp_path / "t.json"), "json")
    assert sorted(tuple(r) for r in df.select("a", "b").collect()) == [("1", "x"), ("2", "")]


def test_write_request_files(spark, tmp_path):
    df = spark.range(2500).selectExpr("id", "concat('ctx ', id) AS context", "CAST(id DIV 1000 AS BIGINT) AS batch_no")
    files.write_embedding_requests(df, str(tmp_path / "req"))
    parts = [p.read_text().splitlines() for p in sorted((tmp_path / "req").glob("batch_group=0/part-*"))]
    assert sorted(map(len, parts)) == [500, 1000, 1000]
    ids = [sorted(int(json.loads(line)["custom_id"].split("-")[1]) for line in p) for p in parts]
    assert sorted(ids) == [list(range(0, 1000)), list(range(1000, 2000)), list(range(2000, 2500))]
