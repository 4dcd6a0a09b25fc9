import zlib

import numpy as np
import pytest
from conftest import ROWS, SF0001

from docweave.llm import packing

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def vocab():
    return public.path("word_bpe_49k.json")


def whole_ids(vocab, text):
    return tokenizers.Tokenizer.from_file(vocab).encode(text or "", add_special_tokens=False).ids + [2]


def check(pieces, texts, vocab, length):
    tok = tokenizers.Tokenizer.from_file(vocab)
    want = sorted(tuple(tok.encode(t or "", add_special_tokens=False).ids + [2]) for t in texts)
    sequences, docs = {}, {}
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u4")
        assert len(ids) == p.length > 0
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
        docs.setdefault((p.sequence_id * length + p.offset - p.start, p.doc_tokens), []).append((p.start, ids))
    for parts in sequences.values():        # gapless from 0
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
    full = [sum(n for _, n in parts) for parts in sequences.values()]
    assert sum(x < length for x in full) <= 1 and sorted(sequences) == list(range(len(sequences)))
    got = []
    for (_, n), parts in docs.items():
        ids = [int(x) for _, part in sorted(parts, key=lambda x: x[0]) for x in part]
        assert len(ids) == n
        got.append(tuple(ids))
    assert sorted(got) == want


@pytest.mark.parametrize("length", [7, 4096])
def test_exact_round_trip(spark, docs, vocab, length):
    check(packing.pack(docs, vocab, length).collect(), [r[1] for r in ROWS], vocab, length)
    df = spark.read.parquet(f"{SF0001}/documents.parquet").repartition(5)
    check(packing.pack(df, vocab, length).collect(), [r.text for r in df.collect()], vocab, length)


def test_pieces_equal_whole_text_encoding(vocab):
    import random
    rng = random.Random(7)
    bits = ["don't", "I'LL", " ", "\n", "\t", " ", " ", "\x1c", "\x85", "é", "́", "ΑΣ", "İ", "ß", "123", "٣", "<|endoftext|>",
            "<|startoftext|>", "!!", "$$$", "日本", "한국", "가", "'s", "'", "-", "_", "ﬁ", "😀", "‍", "a", "Z", "\x0b", "\x0c", "\r"]
    enc, whole = packing._encoder(vocab, False), packing._encoder(vocab, True)
    for _ in range(3000):
        t = "".join(rng.choice(bits) for _ in range(rng.randint(1, 14))).encode()
        assert enc(t) == whole(t), t


def test_empty_table(empty, vocab):
    assert packing.pack(empty, vocab).count() == 0


def test_query_checksum(spark, vocab):
    from docweave.llm.queries import op8_packing
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}
    for r in op8_packing(spark, SF0001).limit(50).collect():
        ids = np.array(whole_ids(vocab, texts[r.doc_id])[r.start:r.start + r.length], dtype="<u4")
        assert r.ids_crc32 == zlib.crc32(ids.tobytes())
