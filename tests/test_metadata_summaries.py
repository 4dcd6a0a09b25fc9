"""D5 by stored summaries: any cut into ordered segments gives the fold of all rows."""
import json
import random

from docweave.operators.enrichment import (
    combine_summaries,
    extend_summaries,
    merge_metadata_by_content,
    summarize_metadata,
    summarized_metadata,
)
from docweave.session import stage

SCHEMA = "content_id long, id long, metadata string, part int"


def _rows(contents, seed=3):
    rnd = random.Random(seed)
    values = [lambda: rnd.choice(["s", "t", "1.50", ""]), lambda: rnd.randint(0, 3), lambda: rnd.choice([1.5, 1e22, -0.0]),
              lambda: None, lambda: [rnd.choice(["a", "b", 1, 1.0, None, {"q": 1}]) for _ in range(rnd.randint(0, 3))],
              lambda: {rnd.choice("xyz"): rnd.choice([0, "v", [1], 2.50]) for _ in range(rnd.randint(0, 2))}]
    data = []
    for cid in range(contents):
        favoured = rnd.sample(values, 2)          # runs of several values are common
        part = 0
        for j in range(rnd.randint(1, 8)):
            part += rnd.random() < 0.4
            m = {k: rnd.choice(favoured if rnd.random() < 0.8 else values)() for k in rnd.sample("abc", rnd.randint(0, 3))}
            data.append((cid, cid * 10 + j, rnd.choice([json.dumps(m)] * 9 + [None]), min(part, 2)))
    return data


def _texts(df):
    return {r.id: r.metadata for r in df.collect()}


def test_any_ordered_segments(spark):
    df = spark.createDataFrame(_rows(150), SCHEMA)
    want = _texts(merge_metadata_by_content(df))
    one, two, three = (stage(summarize_metadata(df.where(f"part = {p}"))) for p in range(3))
    assert _texts(summarized_metadata(combine_summaries(stage(combine_summaries(one, two)), three))) == want
    assert _texts(summarized_metadata(combine_summaries(one, stage(combine_summaries(two, three))))) == want


def test_extending_stored_summaries(spark):
    df = spark.createDataFrame(_rows(60, seed=9), SCHEMA)
    want = _texts(merge_metadata_by_content(df))
    for first, second in (("part = 0", "part > 0"), ("part > 0", "part = 0"), ("id % 2 = 0", "id % 2 = 1")):
        stored, fresh = stage(summarize_metadata(df.where(first))), df.where(second)
        new = stage(extend_summaries(stored, fresh, df))
        touched = {r.content_id for r in fresh.collect()}
        assert {r.cid for r in new.collect()} <= touched
        rest = {c: t for c, t in _texts(summarized_metadata(stored)).items() if c not in touched}
        assert rest | _texts(summarized_metadata(new)) == want, first


def test_contents_in_order_are_not_folded_again(spark):
    df = spark.createDataFrame([(1, 1, '{"a": [1]}', 0), (1, 2, '{"a": [2]}', 0), (2, 3, '{"a": 1}', 0), (1, 4, '{"a": [3]}', 1)], SCHEMA)
    stored = stage(summarize_metadata(df.where("part = 0")))
    nothing = df.limit(0)                         # no row of content 1 is read again
    assert _texts(summarized_metadata(extend_summaries(stored, df.where("part = 1"), nothing))) == {1: '{"a":[1,2,3]}'}


def test_a_replaced_row_is_folded_again(spark):
    stored = stage(summarize_metadata(spark.createDataFrame([(1, 1, '{"a": [1]}', 0), (1, 2, '{"a": [2]}', 0)], SCHEMA)))
    now = spark.createDataFrame([(1, 1, '{"b": 0}', 0), (1, 2, '{"a": [2]}', 0)], SCHEMA)
    assert _texts(summarized_metadata(extend_summaries(stored, now.where("id = 1"), now))) == {1: '{"b":0,"a":[2]}'}


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame([(1, 1, '{"a": [1]}', 0), (2, 1, "{}", 0), (3, 1, None, 0)], SCHEMA)
    assert summarize_metadata(none).count() == 0
    assert _texts(summarized_metadata(extend_summaries(summarize_metadata(none), some, some))) == {1: '{"a":[1]}'}
    assert extend_summaries(stage(summarize_metadata(some)), none, some).count() == 0
