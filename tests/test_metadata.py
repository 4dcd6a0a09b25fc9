"""D1/D2 renderings, D3 question lists, D5 last-run rule, D6 overlay."""
import json
import random

from pyspark.sql import functions as F

from docweave.functions import metadata as md
from docweave.operators.enrichment import merge_metadata_by_content, overlay_json


def _one(spark, expr, value):
    df = spark.createDataFrame([(value,)], "m string")
    return df.select(expr(F.col("m")).alias("x")).first().x


def test_format_v1_and_v2(spark):
    m = json.dumps({"id": 5, "title": "T", "url": "http://x", "empty": "", "n": 3, "flag": True,
                    "none": None, "tags": ["a", "b"], "items": [{"name": "x", "id": 1, "u": "http://y"}],
                    "info": {"k": "v", "blank": ""}, "nothing": []})
    v1 = _one(spark, md.metadata_text_v1, m)
    assert v1 == ("Title: T; N: 3; Flag: True; Tags: a Tags: b items:\nName: x; K: v; \n\n")
    v2 = _one(spark, md.metadata_text_v2, m)
    assert v2 == ("Title: T; N: 3; Flag: True; Tags: a, b\n\nitems:\nName: x; K: v; \n\n")
    assert _one(spark, md.metadata_text_v1, None) is None


def test_clean_meta_list(spark):
    cases = {
        "A? B?": ["A?", "B?"], "A?B?": ["A?", "B?"], "A?, B?": ["A?", "B?"], "A?": ["A?"],
        "none": ["none"], "A? B": ["A?", "B?"],
    }
    for text, expect in cases.items():
        got = _one(spark, lambda c: md.clean_meta_list(md.entry(md.json_entries(c), "q")), json.dumps({"q": text}))
        assert got == expect, text
    for value, expect in [(["x", "y"], ["x", "y"]), (3, ["3"]), (None, ["None"]), ({"k1": 1, "k2": 2}, ["k1", "k2"])]:
        got = _one(spark, lambda c: md.clean_meta_list(md.entry(md.json_entries(c), "q")), json.dumps({"q": value}))
        assert got == expect, value


def _last_run(values):
    """The longest tail of values of one type."""
    tail = [values[-1]]
    for v in values[-2::-1]:
        if type(v) is not type(tail[0]):
            break
        tail.insert(0, v)
    return tail


def _merged(values):
    """SURVEY 2.11 for one key, from all its values in order."""
    run = _last_run(values)
    if isinstance(run[0], list) and len(run) > 1:
        return sorted({x for v in run for x in v})
    if isinstance(run[0], dict):
        return {k: v for d in run for k, v in d.items()}
    return run[-1]


def test_merge_follows_the_last_run_rule(spark):
    rnd = random.Random(11)
    values = [lambda: rnd.choice(["s", "t"]), lambda: rnd.randint(0, 3), lambda: rnd.choice([True, False]),
              lambda: None, lambda: [rnd.choice("abc") for _ in range(rnd.randint(0, 3))],
              lambda: {rnd.choice("xyz"): rnd.randint(0, 2) for _ in range(rnd.randint(1, 2))}]
    data, expect = [], {}
    for cid in range(150):
        rows = []
        for j in range(rnd.randint(1, 5)):
            m = {k: rnd.choice(values)() for k in rnd.sample(["a", "b", "c"], rnd.randint(1, 3))}
            rows.append(m)
            data.append((cid, cid * 10 + j, json.dumps(m)))
        keys = list(dict.fromkeys(k for m in rows for k in m))
        expect[cid] = {k: [m[k] for m in rows if k in m] for k in keys}
    df = spark.createDataFrame(data, "content_id long, id long, metadata string")
    got = {r.id: json.loads(r.metadata) for r in merge_metadata_by_content(df).collect()}
    assert set(got) == set(expect)
    for cid, values in expect.items():
        out = got[cid]
        assert list(out) == list(values), cid          # key order: first seen
        for k, vs in values.items():
            want, have = _merged(vs), out[k]
            many = isinstance(want, list) and len(_last_run(vs)) > 1
            assert (sorted(have) if many else have) == want and type(have) is type(want), (cid, k)
            if isinstance(want, dict):
                assert list(have) == list(want), (cid, k)


def test_overlay(spark):
    df = spark.createDataFrame([('{"a": 1, "b": "x"}', '{"b": null, "c": [1]}'), (None, '{"c": 2}'),
                                ('{"a": 1}', '{"d": {"e": "f"}}')], "cur string, new string")
    got = [json.loads(r.o) for r in df.select(overlay_json(F.col("cur"), F.col("new")).alias("o")).collect()]
    assert got == [{"a": 1, "b": None, "c": [1]}, {"c": 2}, {"a": 1, "d": {"e": "f"}}]
    assert list(got[0]) == ["a", "b", "c"]


def test_enrich_hand_rows(spark):
    from docweave.operators.enrichment import enrich_embeddings
    emb = spark.createDataFrame([
        (1, 10, "c1", None),                                         # no metadata
        (2, 10, "c2", json.dumps({"question": "Why?", "n": 1})),     # metadata with question
        (3, 11, "c3", json.dumps({"keywords": ["old"]})),
        (4, 11, "c4", "{}"),
    ], "id long, content_id_id long, context string, metadata string")
    resp = spark.createDataFrame([
        (1, json.dumps({"questions": ["a?", "b?"], "keywords": "solo"})),   # no content; keywords string
        (2, json.dumps({"content": "R", "keywords": {"k1": 1, "k2": 2}})),  # no questions; keywords dict
        (3, json.dumps({"content": "R3", "questions": "x? y?"})),           # no keywords
        (4, json.dumps({"keywords": ["p", "q"]})),                          # list
        (9, json.dumps({"content": "lost"})),                               # unknown id
    ], "embedding_id long, response string")
    enriched, unmatched = enrich_embeddings(resp, emb, "2024-01-01 00:00:00")
    e = {r.id: r for r in enriched.collect()}
    assert e[1].context == "c1\n\nAdditional Sample Questions: a? b?\nKeywords: solo"
    assert json.loads(e[1].metadata) == {"questions": ["a?", "b?"], "keywords": ["solo"]}
    assert e[2].context == ("Question: Why?\nc2\n\nMetadata:\nQuestion: Why?; N: 1; \n\n\n\n"
                            "Rephrased Content: R\nKeywords: k1 k2")
    assert json.loads(e[2].metadata) == {"question": "Why?", "n": 1, "keywords": ["k1", "k2"]}
    assert e[3].context == "c3\n\nMetadata:\nKeywords: old\n\n\n\n\n\nRephrased Content: R3\nAdditional Sample Questions: x? y?\n"
    assert json.loads(e[3].metadata) == {"keywords": ["old"], "questions": ["x?", "y?"]}
    assert e[4].context == "c4\n\nMetadata:\n\n\n\n\nKeywords: p q"
    assert [r.embedding_id for r in unmatched.collect()] == [9]


def test_new_content_tags_skip_stored_pairs(spark):
    from docweave.operators.tags import new_content_tag_pairs
    merged = spark.createDataFrame([(1, json.dumps({"keywords": ["A b", "c", "c"]})), (2, json.dumps({}))],
                                   "id long, metadata string")
    ids = spark.createDataFrame([("a-b", 10), ("c", 11)], "key string, tag_id long")
    stored = spark.createDataFrame([(1, 10)], "content_id long, tag_id long")
    assert [tuple(r) for r in new_content_tag_pairs(merged, ids, stored).collect()] == [(1, 11)]


# One line per rule of SURVEY D1 and D2: metadata, first rendering, second rendering (without the closing blank lines).
RENDERINGS = [
    ({}, "", ""),
    ({"a": "x"}, "A: x; ", "A: x; "),
    ({"two words": "x"}, "Two Words: x; ", "Two Words: x; "),
    ({"a": ""}, "", ""),
    ({"a": "see http://x"}, "", ""),
    ({"id": 7, "context": "c", "b": 1}, "B: 1; ", "B: 1; "),
    ({"a": None}, "", ""),
    ({"a": 0, "b": False, "c": True}, "A: 0; B: False; C: True; ", "A: 0; B: False; C: True; "),
    ({"a": 1.5}, "A: 1.5; ", "A: 1.5; "),
    ({"a": {"k": "v", "id": 3, "e": "", "n": None, "u": "http"}}, "K: v; ", "K: v; "),
    ({"a": {}}, "", ""),
    ({"a": []}, "", ""),
    ({"a": ["x"]}, "A: x ", "A: x\n\n"),
    ({"a": ["x", 2, True, None, ""]}, "A: x A: 2 A: True A: None A:  ", "A: x, 2, True, None, \n\n"),
    ({"a": ["http://x"]}, "A: http://x ", "A: http://x\n\n"),
    ({"aa": [{"k": "v"}, {"id": 1}]}, "aa:\nK: v; aa:\n", "aa:\nK: v; aa:\n"),
    ({"z": 1, "a": 2, "m": 3}, "Z: 1; A: 2; M: 3; ", "Z: 1; A: 2; M: 3; "),
]


def test_renderings(spark):
    df = spark.createDataFrame([(i, json.dumps(m)) for i, (m, _, _) in enumerate(RENDERINGS)], "i int, m string")
    rows = df.select("i", md.metadata_text_v1("m").alias("a"), md.metadata_text_v2("m").alias("b")).collect()
    for r in rows:
        m, first, second = RENDERINGS[r.i]
        assert r.a == first + "\n\n", m
        assert r.b == second + "\n\n", m


def test_repeated_keys_and_long_objects(spark):
    import time

    df = spark.createDataFrame([('{"a": 1, "b": 2, "a": "x"}',)], "m string")
    got = df.select(md.json_entries("m").alias("e")).first().e
    assert [tuple(e) for e in got] == [("a", "str", "x"), ("b", "int", "2")]
    big = json.dumps({f"key {i}": [i, "v"][i % 2] for i in range(8000)})
    new = json.dumps({f"key {i}": None for i in range(4000, 12000)})
    df = spark.createDataFrame([(big, new)], "m string, n string")
    t = time.time()
    text = df.select(md.metadata_text_v1("m").alias("a")).first().a
    assert text.startswith("Key 0: 0; Key 1: v; ") and text.endswith("Key 7999: v; \n\n")
    over = json.loads(df.select(overlay_json(F.col("m"), F.col("n")).alias("o")).first().o)
    assert len(over) == 12000 and over["key 3999"] == "v" and over["key 4000"] is None and list(over)[-1] == "key 11999"
    assert time.time() - t < 30


def test_parsed_and_tokenized_once(spark):
    """An expression inside a lambda runs once per element: the text functions must stay outside."""
    from docweave.operators.chunking import window_chunks

    df = spark.createDataFrame([("{}", "a b")], "m string, t string")
    plan = lambda d: d._jdf.queryExecution().optimizedPlan().toString()
    assert plan(df.select(window_chunks(F.col("t"), 4, 2).alias("x"))).count("regexp_extract_all") == 1
    assert plan(df.select(md.json_entries("m").alias("x"))).count("from_json") == 2
    assert plan(df.select(overlay_json(F.col("m"), F.col("t")).alias("x"))).count("from_json") == 4
