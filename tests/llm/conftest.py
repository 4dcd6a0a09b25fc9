import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF0001 = "/root/testdata/sf0.001"

#: null, empty, blank and long texts, ties, repeated rows, white space variants, a null id and source
ROWS = [
    (1, "The quick  brown fox", "en", "b", 20), (2, "The quick brown\tfox", "en", "b", 19), (3, None, "en", None, None),
    (4, "", None, "a", 0), (5, " \t\n", "de", "a", 3), (6, "one two", "de", "c", 7), (6, "one two", "de", "c", 7),
    (7, "ONE TWO", "de", "c", 7), (8, "été à ΑΣ <|endoftext|> 123's", "fr", "é", 27), (9, "x" * 70_000 + " y" * 9_000, "en", "z", None),
    (None, "no id here at all", "en", "a", 17), (11, "The quick brown fox", "en", "b", 19), (12, "a b\x1cc\x85d é", "fr", "c", 9),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def spark():
    from docweave.session import ensure_checkpoint_dir, local_session
    s = local_session(4, shuffle_partitions=4)
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def docs(spark):
    """The edge rows, with extra columns whose names clash with internal ones."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    for name in ("id", "raw", "size", "part", "fp", "run", "digest", "copies", "key", "target", "x.y"):
        df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
