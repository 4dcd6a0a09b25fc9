"""Files cut into many splits: the same rows as a reader that takes a file whole."""
import json
import random

import pytest

from docweave.sources import files, records


@pytest.fixture()
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield lambda n: spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
    for k, v in before.items():
        spark.conf.set(k, v)


CELLS = ["plain", "", "NA", 'say "hi"', "a,b", "line\nbreak", "crlf\r\nbreak", '"', '""\n"', "é x", "x" * 300, "\n\n", "1.50", "{[\\"]

def _cells(rng, n):
    return [(str(i), rng.choice(CELLS), rng.choice(CELLS)) for i in range(n)]


def _csv(rows, end):
    quoted = lambda c: '"' + c.replace('"', '""') + '"' if any(x in c for x in '",\n\r') else c
    return end.join([",".join(map(quoted, r)) for r in [("k", "a", "b"), *rows]]) + end


@pytest.mark.parametrize("size,end", [(97, "\n"), (1000, "\r\n"), (10_000_000, "\n")])
def test_csv_in_splits(spark, tmp_path, small_splits, size, end):
    rng = random.Random(size)
    want = []
    for k, n in enumerate((1, 60, 200)):
        rows = _cells(rng, n)
        want += rows
        (tmp_path / f"f{k}.csv").write_bytes(_csv(rows, end).encode())
    small_splits(size)
    got = [tuple(r) for r in records.read_csv(spark, str(tmp_path)).na.fill("").collect()]
    assert sorted(got) == sorted(want)


def test_one_large_file_is_read_by_many_tasks(spark, tmp_path, small_splits):
    rng = random.Random(1)
    rows = [(str(i), rng.choice(['note "q", ', "two\nlines ", "plain "]) + "w " * 40, "z") for i in range(40_000)]
    (tmp_path / "big.csv").write_text(_csv(rows, "\n"))
    whole = files.read_tabular(spark, str(tmp_path), "csv", split=False)
    small_splits(300_000)
    split = files.read_tabular(spark, str(tmp_path), "csv")
    assert records._pieces(spark, str(tmp_path), "\n").rdd.getNumPartitions() >= 8
    assert split.columns == whole.columns and split.count() == len(rows)
    assert split.exceptAll(whole).count() == 0


def _record(rng, i):
    nested = [{"t": "}{][\"\\", "n": [1, {"x": "]"}]}, [], {"deep": {"er": {"s": "a\nb"}}}, None, "text } \" \\\" {", "\\", 1.5, True]
    return {"k": i, "a": rng.choice(["x", "}", '"', "\\", "é{", "{[", None]), "v": rng.choice(nested), "w": "y" * rng.randrange(80)}


@pytest.mark.parametrize("size", [61, 700, 10_000_000])
@pytest.mark.parametrize("shape", ["array", "pretty", "lines"])
def test_json_in_splits(spark, tmp_path, small_splits, size, shape):
    rng = random.Random(size)
    want = []
    for k, n in enumerate((0, 1, 120)):
        rows = [_record(rng, i) for i in range(n)]
        want += rows
        text = "\n".join(map(json.dumps, rows)) if shape == "lines" else json.dumps(rows, indent=2 if shape == "pretty" else None, ensure_ascii=False)
        (tmp_path / f"f{k}.json").write_text(text)
    small_splits(size)
    got = [json.loads(r.record) for r in records.json_records(spark, str(tmp_path)).collect()]
    key = lambda x: json.dumps(x, sort_keys=True)
    assert sorted(map(key, got)) == sorted(map(key, want))


def test_read_json_equals_whole_reader(spark, tmp_path, small_splits):
    rng = random.Random(9)
    rows = [{"k": i, "a": rng.choice(["x", "}", None, "two\nlines"]), "v": rng.choice([1, 2.5, None])} for i in range(3000)]
    (tmp_path / "r.json").write_text(json.dumps(rows))
    whole = files.read_tabular(spark, str(tmp_path), "json", split=False)
    small_splits(10_000)
    split = files.read_tabular(spark, str(tmp_path), "json")
    assert sorted(map(tuple, split.select(whole.columns).collect())) == sorted(map(tuple, whole.collect()))
