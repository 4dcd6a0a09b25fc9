"""C3 recursive splitter (hand-checked example, properties, Spark = Python),
C3 window variant, C4 rows, and the stage-1 flagship."""
import hashlib
import random

from pyspark.sql import functions as F

from docweave.operators.chunking import chunk_recursive, chunk_window, embedding_records, pretoken_len, split_recursive
from docweave.plans.jobs import preprocess_job

from conftest import SF0001


def test_merge_with_overlap_by_hand():
    # char lengths: "a"=1, " b"=2, ...; size 5, overlap 2
    assert split_recursive("a b c d e f g", 5, 2, length=len) == ["a b c", "c d", "d e", "e f", "f g"]


def test_separators_recurse():
    text = "para one\n\npara two is longer\nwith a second line"
    chunks = split_recursive(text, 4, 0, length=lambda s: len(s.split()))
    assert chunks == ["para one", "para two is longer", "with a second line"]
    assert split_recursive("", 400, 200) == []
    assert split_recursive("   ", 400, 200) == []
    assert split_recursive("word", 400, 200) == ["word"]


def test_chunks_bounded_and_ordered():
    rnd = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "x", "longerword", "42", "3.14"]
    for _ in range(30):
        parts = []
        for _ in range(rnd.randint(1, 1500)):
            parts.append(rnd.choice(words))
            parts.append(rnd.choice([" ", " ", " ", "\n", "\n\n"]))
        text = "".join(parts).strip()
        chunks = split_recursive(text)
        assert all(pretoken_len(c) <= 400 for c in chunks)
        pos = 0
        for c in chunks:                       # chunks appear in text order
            found = text.find(c, max(0, pos - 5000))
            assert found >= 0
            pos = found


def test_spark_recursive_equals_python(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    got = chunk_recursive(docs, "text", ["doc_id"]).orderBy("doc_id", "idx").collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    expect = [(d, i, c) for d in sorted(texts) for i, c in enumerate(split_recursive(texts[d]))]
    assert [(r.doc_id, r.idx, r.text) for r in got] == expect


def test_window_chunks_cover_text(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").limit(50)
    rows = chunk_window(docs, "text", ["doc_id"], size=40, overlap=10).collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append((r.idx, r.text))
    for d, chunks in by_doc.items():
        assert [i for i, _ in sorted(chunks)] == list(range(len(chunks)))
        assert all(pretoken_len(c) >= 1 for _, c in chunks)


def test_preprocess_job_rows(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").selectExpr("doc_id AS id", "text AS content")
    out = preprocess_job(docs).collect()
    assert out
    for r in out[:50]:
        assert r.text_sha256 == hashlib.sha256(r.text.encode()).hexdigest()
        assert r.token_count == pretoken_len(r.text)
        assert r.token_count <= 400


def test_entry_smoke(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.columns == ["context_version_id", "idx", "text", "text_sha256", "token_count"]
    assert df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_token_boundaries():
    def words(n):
        return "a" + " a" * (n - 1)          # n pre-tokens: "a", " a", ...
    assert pretoken_len(words(400)) == 400
    assert split_recursive(words(400)) == [words(400)]
    two = split_recursive(words(401))
    assert len(two) == 2 and pretoken_len(two[0]) == 400 and pretoken_len(two[1]) == 201
    six = split_recursive(words(600))
    assert len(six) == 2 and pretoken_len(six[1]) == 400       # the last 200 carried over
    assert split_recursive("word") == ["word"]


def test_single_piece_above_size_splits_by_character():
    text = "1" * 1500                         # no separator; 500 pre-tokens
    chunks = split_recursive(text)
    assert all(len(c) <= 400 for c in chunks)
    assert "".join(c[200:] if i else c for i, c in enumerate(chunks)) == text   # 200-char overlaps


def test_special_token_text_and_emoji_are_text():
    assert pretoken_len("<|endoftext|>") == 3
    assert pretoken_len("\U0001F600\U0001F600 ok") == 2
    assert split_recursive("hi <|endoftext|> there \U0001F600") == ["hi <|endoftext|> there \U0001F600"]


def _tiny_vocab(path):
    """All 256 bytes plus two merges: b'ab' (256) and b' a' (257)."""
    import base64
    tokens = [bytes([b]) for b in range(256)] + [b"ab", b" a"]
    path.write_text("\n".join(f"{base64.b64encode(t).decode()} {i}" for i, t in enumerate(tokens)))
    return str(path)


def test_a_worker_splits_few_texts_at_a_time():
    """The first rows of a batch are given back before most of its texts are split."""
    import pyarrow as pa
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    class Frame:
        """Hands out the function that Spark would run."""
        schema = StructType([StructField("id", LongType()), StructField("text", StringType())])

        def select(self, *cols):
            return self

        def mapInArrow(self, run, schema):
            return run

    seen = []
    run = chunk_recursive(Frame(), "text", ["id"], size=3, overlap=1, length=lambda t: seen.append(t) or pretoken_len(t))
    texts = [None if i % 10 == 0 else f"a{i} b c d e f" for i in range(1000)]
    rows = run(iter([pa.RecordBatch.from_arrays([pa.array(range(1000)), pa.array(texts)], ["id", "text"])]))
    first = next(rows).to_pylist()
    assert len({t for t in seen if t.startswith("a")}) <= 32
    rest = [r for b in rows for r in b.to_pylist()]
    assert [(r["id"], r["idx"], r["text"]) for r in first + rest] == [
        (i, k, c) for i, t in enumerate(texts) if t is not None for k, c in enumerate(split_recursive(t, 3, 1))]


def test_recursive_records_keep_the_columns_beside_null(spark):
    """Keys beyond 2^53 in a batch that also holds nulls."""
    big = 2 ** 53 + 1
    rows = [(big, "a b", None, big, None, 1), (2, "c", '{"question": "q"}', None, big, None), (3, None, None, 1, 1, 1)]
    content = spark.createDataFrame(rows, "id long, content string, metadata string, type_id long, user_id_id long, application_id_id long").coalesce(1)
    got = embedding_records(content, "2024-01-01 00:00:00", splitter="recursive").collect()
    assert sorted((r.content_id_id, r.chunk_idx, r.type_id_id, r.user_id_id, r.application_id_id) for r in got) == [
        (2, 0, None, big, None), (big, 0, big, None, 1)]
