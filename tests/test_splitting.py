"""C3 as column expressions: rows equal to the Python splitter, plan, long texts."""
import random
import time

import pytest
from pyspark.sql import functions as F

from docweave.operators.chunking import chunk_recursive, chunk_recursive_native, split_recursive
from docweave.operators.splitting import split_chunks


def _random_texts(n):
    rnd = random.Random(7)
    parts = ["a", "bb", "7777", " ", "  ", "\n", "\n\n", "\n\n\n", ".", ", ", "x" * 30, "é\U0001F600", "　", "1" * 40, "\x1c"]
    return [(i, "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 150)))) for i in range(n)]


@pytest.mark.parametrize("size,overlap", [(5, 2), (20, 10), (2, 1), (8, 0), (12, 11), (400, 200)])
def test_equals_python_splitter(spark, size, overlap):
    texts = _random_texts(150)
    df = spark.createDataFrame(texts + [(1000, None)], "id int, text string")
    got = {(r.id, r.idx): r.text for r in chunk_recursive_native(df, "text", ["id"], size, overlap).collect()}
    assert got == {(d, i): c for d, t in texts for i, c in enumerate(split_recursive(t, size, overlap))}


def test_columns_and_plan(spark):
    df = spark.createDataFrame(_random_texts(40), "id int, text string")
    native, python = chunk_recursive_native(df, "text", ["id"], 10, 4), chunk_recursive(df, "text", ["id"], 10, 4)
    assert [(f.name, f.dataType) for f in native.schema] == [(f.name, f.dataType) for f in python.schema]
    assert sorted(native.collect()) == sorted(python.collect())
    plan = native._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_columns_with_clashing_names(spark):
    df = spark.createDataFrame([(1, "a b c", "p", "n")], "id int, text string, p string, n string")
    assert [tuple(r) for r in chunk_recursive_native(df, "text", ["id", "p", "n"], 2, 0).collect()] == [
        (1, "p", "n", 0, "a b"), (1, "p", "n", 1, "c")]
    assert chunk_recursive_native(df.limit(0), "text", ["id"]).count() == 0


def test_bad_sizes_are_refused():
    for size, overlap in ((1, 0), (5, 5), (5, -1)):
        with pytest.raises(ValueError):
            split_chunks(F.lit("a"), size, overlap)


def test_long_texts_take_time_in_proportion(spark):
    def seconds(mb):
        one = spark.range(1).select("id", F.repeat(F.lit("some words of text, 12 of them. "), int(mb * 32768)).alias("text"))
        start = time.time()
        chunks = chunk_recursive_native(one, "text", ["id"]).count()
        return time.time() - start, chunks

    seconds(0.5)
    (small, n1), (large, n4) = seconds(1), seconds(4)
    assert n4 > 3.9 * n1 and large < 10 * small + 2
