"""The columns the queries promise, and the SQL of those that have it."""
import pytest
from conftest import SF0001

from docweave.llm import queries

COLUMNS = {
    "op1_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op3_mixing": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op6_forest": {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op7_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op8_packing": {"doc_id": "bigint", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "doc_tokens": "bigint",
                    "sequence_id": "bigint", "offset": "bigint"},
    "op9_suffix_dedup": {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
    "op11_prefix_trie": {c: "bigint" for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")}
    | {"ends_sha256": "string"},
    "op12_periodic_runs": {c: "bigint" for c in ("doc_id", "n_runs", "start", "length", "period", "exponent_milli")}
    | {"runs_sha256": "string", "collapsed_sha256": "string"},
    "op13_decontaminate": {"doc_id": "bigint", "n_words": "bigint", "n_hit": "bigint", "n_items": "bigint", "items_sha256": "string",
                           "contaminated": "boolean"},
    "op10_exact_dedup": {"doc_id": "bigint", "keep_id": "bigint", "group_size": "bigint", "kept": "boolean", "text_sha256": "string"},
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, name):
    df = queries.QUERIES[name](spark, SF0001)
    kinds = dict(df.dtypes)
    assert {c: kinds.get(c) for c in COLUMNS[name]} == COLUMNS[name]
    if name == "op7_simhash":
        assert df.where("fingerprint not rlike '^[0-9a-f]{16}$'").count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_equals_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for tab in ("documents", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {tab} AS SELECT * FROM '{SF0001}/{tab}.parquet'")
    df = queries.QUERIES[name](spark, SF0001)
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({queries.ORACLES[name]})").fetchall()
    key = lambda rows: sorted(str(tuple(round(v, 6) if isinstance(v, float) else v for v in r)) for r in rows)
    assert key(df.collect()) == key(want)
