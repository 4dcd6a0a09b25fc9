"""Every stage of the pipeline against a brute-force version on its own input."""
import re

import corpus_pipeline
from conftest import ROWS, SF0001
from test_packing import check, vocab  # noqa: F401
from test_simhash import components, fingerprint

from docweave.llm.common import stage


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", "", t or "")


def test_stages_on_the_table(spark, vocab):  # noqa: F811
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    columns, seen = docs.columns, []
    for name, step in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = stage(step(spark, docs, SF0001), name)
        after = docs.collect()
        seen.append(name)
        if name != "packing":
            assert docs.columns == columns and {tuple(r) for r in after} <= {tuple(r) for r in before}
        if name == "exact_dedup":
            best = {}
            for r in before:
                k = norm(r.text)
                best[k] = min(best.get(k, (1, 0)), (-len(r.text), r.doc_id))
            assert {r.doc_id for r in after} == {i for _, i in best.values()} and len(after) == len(best)
        if name == "simhash_near_dedup":
            want = {c for _, c in components([(r.doc_id, fingerprint(r.text)) for r in before])}
            assert {r.doc_id for r in after} == want and len(after) == len(want)
        if name == "mixing":
            mixed = [r.text for r in after]
            assert len(mixed) > len({r.doc_id for r in after}) > 0
        if name == "packing":
            assert sum(r.length for r in after) == sum({(r.doc_id, r.sequence_id * 4096 + r.offset - r.start): r.doc_tokens for r in after}.values())
            from docweave.llm import packing
            check(packing.pack(spark.createDataFrame(before), vocab).collect(), mixed, vocab, 4096)
    assert seen == ["quality_classifier", "exact_dedup", "simhash_near_dedup", "mixing", "packing"]
    assert corpus_pipeline.run(spark, SF0001).columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_stages_on_edge_rows_and_empty_tables(spark, docs, empty, tmp_path):
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 1), (7, None, 0), (5, 0, 0), (8, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for table in (docs, empty):
        now = table
        for name, step in corpus_pipeline.STAGES:
            now = stage(step(spark, now, str(tmp_path)), name)
            if name != "packing":
                assert now.columns == table.columns
            assert now.count() <= 3 * len(ROWS)
