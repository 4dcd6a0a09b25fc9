import hashlib
import re
from collections import defaultdict

from conftest import ROWS

from docweave.llm.exact_dedup import drop_exact_duplicates, exact_duplicates


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", "", t or "")


def test_groups_equal_brute_force(docs):
    groups = defaultdict(list)
    for r in ROWS:
        groups[norm(r[1])].append(r)
    got = sorted((str(r.id), str(r.keep_id), r.group_size, r.text_sha256) for r in exact_duplicates(docs, fan_bits=1).collect())
    want = []
    for key, rows in groups.items():
        best = min(rows, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
        want += [(str(r[0]), str(best[0]), len(rows), hashlib.sha256(key.encode()).hexdigest()) for r in rows]
    assert got == sorted(want)


def test_one_row_of_each_group_stays_with_all_columns(docs):
    kept = drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    texts = [norm(r.text) for r in kept.collect()]
    assert sorted(texts) == sorted({norm(r[1]) for r in ROWS})
    assert {r.doc_id for r in kept.collect() if norm(r.text) == "Thequickbrownfox"} == {1}


def test_empty_table(empty):
    assert exact_duplicates(empty).count() == 0
    assert drop_exact_duplicates(empty).columns == empty.columns


def test_hot_text_over_many_runs(spark):
    from pyspark.sql import functions as F
    df = spark.range(0, 3000, 1, 40).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("same text"))
                                            .otherwise(F.concat(F.lit("t"), F.col("id"))).alias("text"))
    out = exact_duplicates(df, fan_bits=2)
    assert out.where("kept").count() == 2001
    assert [(r.keep_id, r.group_size) for r in out.where("id = 2997").collect()] == [(0, 1000)]
