"""Exact token counts against an encoder over the same vocabulary."""
import base64
import random

import pytest

from conftest import SF001
from docweave.operators import tokens
from docweave.operators.chunking import chunk_recursive

tiktoken = pytest.importorskip("tiktoken")
public = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def encoder():
    with open(public.path("byte_bpe_50k.tiktoken"), "rb") as fh:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, fh)}
    return ranks, tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_merges_equal_the_encoder(encoder):
    ranks, enc = encoder
    rng = random.Random(1)
    for _ in range(3000):
        t = "".join(rng.choice("aabcdeé ñ1中😀\n'") for _ in range(rng.randrange(1, 40)))
        assert tokens.token_length(ranks, public.PATTERN)(t) == len(enc.encode_ordinary(t))
    long = b"ab" * 40_000
    assert tokens.merged_tokens(long, ranks) == len(enc._encode_single_piece(long))


@pytest.mark.parametrize("hot", [tokens.HOT_BYTES, 20_000])
def test_all_documents_equal_the_encoder(spark, encoder, hot):
    """With the whole dictionary broadcast, and with its rare pieces shuffled."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    more = spark.createDataFrame([(None, "no id"), (-1, None), (-2, ""), (-3, "x" * 50_000 + "<|endoftext|> 123's"), (-4, "twice"), (-4, "twice")],
                                 docs.schema)
    docs = docs.unionByName(more)
    got = tokens.exact_token_counts(docs, "text", ["doc_id"], public.path("byte_bpe_50k.tiktoken"), public.PATTERN, hot).collect()
    want = [(r.doc_id, None if r.text is None else len(encoder[1].encode_ordinary(r.text))) for r in docs.collect()]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_splitter_with_exact_lengths(spark, encoder):
    ranks, enc = encoder
    docs = spark.read.parquet(f"{SF001}/documents.parquet").limit(100)
    rows = chunk_recursive(docs, "text", ["doc_id"], length=tokens.token_length(ranks, public.PATTERN)).collect()
    # pieces are counted one by one: joined they can only become fewer tokens, but for blanks at the seams
    assert rows and max(len(enc.encode_ordinary(r.text)) for r in rows) <= 410
