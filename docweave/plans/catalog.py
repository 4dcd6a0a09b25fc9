"""Registered queries: one per operator of the inventory, each reading the
driver's tables in full, plus the DuckDB SQL that computes the same result.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLES[name] -> str``.
Queries without an oracle are checked by row count here and against
brute-force Python models in the tests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.functions import metadata as md
from docweave.functions.text import (
    build_context,
    normalize_text,
    slug_key,
    title_name,
    token_count,
    type_key,
)
from docweave.operators import chunking, enrichment, lifecycle, tables, tags, tokens
from docweave.plans import duck as D
from docweave.plans import fixtures as X
from docweave.plans.jobs import complete_job, nonempty_content, preprocess_job
from docweave.session import spread_scan, stage
from docweave.sources import files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return wrap


def T(spark, d, name):
    return X.table(spark, d, name)


def TS(spark, d, name):
    """A table dealt over all cores, for work that is heavy per row."""
    return spread_scan(T(spark, d, name))


def content(spark, d):
    return TS(spark, d, "documents").selectExpr(*X.CONTENT, "lang", "source", "n_chars")


DUCK_CONTENT = X.duck_fixture("documents", X.CONTENT + ["lang", "source", "n_chars"])
AS_OF = X.AS_OF

# --- A1 / A2 / A3 / B1 ---------------------------------------------------------------

@register("content_nonempty", """
SELECT d.doc_id AS id, d.n_chars FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
WHERE CASE WHEN l.toxic = 1 THEN NULL WHEN l.quality = 0 THEN '' ELSE d.text END IS NOT NULL
  AND CASE WHEN l.toxic = 1 THEN NULL WHEN l.quality = 0 THEN '' ELSE d.text END <> ''
""")
def q_content_nonempty(spark, d):
    docs, labels = T(spark, d, "documents"), T(spark, d, "labels")
    c = docs.join(labels, "doc_id", "left").select(
        F.col("doc_id").alias("id"), "n_chars",
        F.expr("CASE WHEN toxic = 1 THEN NULL WHEN quality = 0 THEN '' ELSE text END").alias("content"))
    return nonempty_content(c).select("id", "n_chars")


@register("content_lookup", """
SELECT doc_id AS id, lang, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)
""")
def q_content_lookup(spark, d):
    docs = T(spark, d, "documents").withColumnRenamed("doc_id", "id")
    return tables.lookup(docs, T(spark, d, "labels").select("doc_id"), ["id", "lang", "source"])


@register("content_filter", """
SELECT doc_id AS id, source, n_chars FROM documents WHERE lang = 'de' AND n_chars > 1000
""")
def q_content_filter(spark, d):
    docs = T(spark, d, "documents").withColumnRenamed("doc_id", "id")
    return tables.filter_table(docs, "lang = 'de' AND n_chars > 1000").select("id", "source", "n_chars")


@register("embedding_ids_by_content", """
SELECT conv_id * 100 + turn AS id FROM conversations WHERE conv_id IN (SELECT doc_id FROM labels)
""")
def q_embedding_ids_by_content(spark, d):
    emb = X.spark_fixture(spark, d, "conversations", X.CONV_EMBEDDINGS)
    return tables.child_ids(emb, T(spark, d, "labels").select("doc_id"))


# --- C1 / C1d / C2 / C3 / C4 ---------------------------------------------------------------

@register("normalize_text", D.chain(
    f"SELECT doc_id, {X.DIRTY_TEXT} AS dirty FROM documents", ["doc_id"], "dirty", D.normalize_steps()
))
def q_normalize_text(spark, d):
    docs = TS(spark, d, "documents").selectExpr("doc_id", f"{X.DIRTY_TEXT} AS dirty")
    return docs.select("doc_id", normalize_text("dirty").alias("s"))


@register("html_to_text", D.chain(
    f"SELECT page_id, {X.PAGE_EXTRA} AS h FROM pages", ["page_id"], "h", D.normalize_steps()))
def q_html_to_text(spark, d):
    pages = TS(spark, d, "pages").selectExpr("page_id", f"{X.PAGE_EXTRA} AS h")
    return pages.select("page_id", normalize_text("h").alias("s"))


@register("token_count", f"SELECT doc_id, {D.token_count('text')} AS token_count FROM documents")
def q_token_count(spark, d):
    return TS(spark, d, "documents").select("doc_id", token_count("text").alias("token_count"))


@register("token_count_exact", None)
def q_token_count_exact(spark, d):
    """C2 with the 50k byte-level vocabulary of the public tokenizer files."""
    import public_tokenizers

    return tokens.exact_token_counts(TS(spark, d, "documents"), "text", ["doc_id"], public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                     public_tokenizers.PATTERN)


@register("chunk_window", f"""
SELECT doc_id, CAST(generate_subscripts(chunks, 1) - 1 AS INTEGER) AS idx, unnest(chunks) AS text
FROM (SELECT doc_id, {D.window_chunks()} AS chunks
      FROM ({D.pretokens_select('SELECT doc_id, text FROM documents', ['doc_id'], 'text')}))
""")
def q_chunk_window(spark, d):
    return chunking.chunk_window(TS(spark, d, "documents"), "text", ["doc_id"])


def _duck_chunk_records() -> str:
    norm = D.chain(f"SELECT doc_id, {X.DIRTY_TEXT} AS dirty FROM documents", ["doc_id"], "dirty",
                   D.normalize_steps())
    toks = D.pretokens_select(norm, ["doc_id"], "s")
    chunks = f"SELECT doc_id, {D.window_chunks()} AS chunks FROM ({toks})"
    rows = (f"SELECT doc_id AS context_version_id, CAST(generate_subscripts(chunks, 1) - 1 AS INTEGER) AS idx, "
            f"unnest(chunks) AS text FROM ({chunks})")
    return (f"SELECT context_version_id, idx, text, sha256(text) AS text_sha256, {D.token_count('text')} "
            f"AS token_count FROM ({rows})")


@register("chunk_records", _duck_chunk_records())
def q_chunk_records(spark, d):
    docs = TS(spark, d, "documents").selectExpr("doc_id AS content_id", f"{X.DIRTY_TEXT} AS dirty")
    clean = docs.select("content_id", normalize_text("dirty").alias("text"))
    return chunking.chunk_records(chunking.chunk_window(clean, "text", ["content_id"]))


def _duck_recursive_records(text: str) -> str:
    norm = D.chain(f"SELECT doc_id AS id, {text} AS raw FROM documents", ["id"], "raw", D.normalize_steps())
    return (f"SELECT id AS context_version_id, idx, chunk AS text, sha256(chunk) AS text_sha256, {D.token_count('chunk')} AS token_count "
            f"FROM ({D.recursive_chunks(f'SELECT id, s AS t FROM ({norm})')})")


@register("chunk_recursive", _duck_recursive_records(X.DIRTY_TEXT))
def q_chunk_recursive(spark, d):
    """C1 -> C3 (recursive splitter) -> C4 over every document: the stage-1 job."""
    c = TS(spark, d, "documents").selectExpr("doc_id AS id", f"{X.DIRTY_TEXT} AS content")
    return preprocess_job(c)


@register("chunk_recursive_native", _duck_recursive_records(X.DIRTY_TEXT))
def q_chunk_recursive_native(spark, d):
    """The rows of ``chunk_recursive``, split by column expressions."""
    c = TS(spark, d, "documents").selectExpr("doc_id AS id", f"{X.DIRTY_TEXT} AS content")
    return preprocess_job(c, splitter="native")


# --- C5 / C6 / C7 / C8 / C9 -------------------------------------------------------------------

@register("build_context", """
SELECT p_partkey, 'P_NAME: ' || coalesce(p_name, 'None') || '; ' || chr(10) || 'P_BRAND: ' || coalesce(p_brand, 'None')
  || '; ' || chr(10) || 'P_TYPE: ' || coalesce(p_type, 'None') || '; ' || chr(10) || 'P_SIZE: '
  || coalesce(CAST(p_size AS VARCHAR), 'None') || '; ' AS context FROM part
""")
def q_build_context(spark, d):
    part = T(spark, d, "part")
    return part.select("p_partkey", build_context(part, ["p_name", "p_brand", "p_type", "p_size"]).alias("context"))


def _duck_embedding_records(recursive: bool = False) -> str:
    toks = D.pretokens_select(DUCK_CONTENT, ["id", "metadata", "type_id", "user_id_id", "application_id_id"], "content")
    chunks = (f"SELECT id, metadata, type_id, user_id_id, application_id_id, {D.window_chunks()} AS chunks "
              f"FROM ({toks})")
    rows = (f"SELECT id, metadata, type_id, user_id_id, application_id_id, "
            f"generate_subscripts(chunks, 1) - 1 AS chunk_idx, unnest(chunks) AS chunk FROM ({chunks})")
    if recursive:
        rows = (f"SELECT d.id, metadata, type_id, user_id_id, application_id_id, idx AS chunk_idx, chunk FROM ({DUCK_CONTENT}) d "
                f"JOIN ({D.recursive_chunks('SELECT doc_id AS id, text AS t FROM documents')}) k ON k.id = d.id")
    ents = D.entries("metadata")
    with_q = (f"CASE WHEN {D.has_key(ents, 'question')} THEN 'Question: ' || "
              f"{D.render(D.entry(ents, 'question'))} || chr(10) || 'Answer: ' || chunk ELSE chunk END")
    context = (f"CASE WHEN len({ents}) > 0 THEN {with_q} || chr(10) || chr(10) || 'Metadata:' || "
               f"{D.metadata_text_v1('metadata')} ELSE {with_q} END")
    return (f"SELECT {context} AS context, {D.token_count('chunk')} AS tokens, metadata, id AS content_id_id, "
            f"CAST(chunk_idx AS INTEGER) AS chunk_idx, type_id AS type_id_id, user_id_id, application_id_id, "
            f"'add to batch' AS status, TIMESTAMP '{AS_OF}' AS posted_at, TIMESTAMP '{AS_OF}' AS updated_at, "
            f"TIMESTAMP '{AS_OF}' AS created_at FROM ({rows})")


@register("embedding_records", _duck_embedding_records())
def q_embedding_records(spark, d):
    return chunking.embedding_records(content(spark, d), AS_OF, splitter="window")


@register("embedding_updates", f"""
SELECT conv_id * 100 + turn AS id, text AS context, {D.token_count('text')} AS tokens,
  CASE WHEN turn = 5 THEN NULL ELSE '{{"role": "' || role || '", "turn": ' || turn
    || CASE WHEN role = 'system' THEN ', "question": "Who is ' || role || '?"' ELSE '' END
    || ', "url": "http://c/' || conv_id || '"}}' END AS metadata,
  turn % 3 AS type_id_id, 1 AS application_id_id, 'add to batch' AS status, TIMESTAMP '{AS_OF}' AS updated_at
FROM conversations
""")
def q_embedding_updates(spark, d):
    emb = X.spark_fixture(spark, d, "conversations", X.CONV_EMBEDDINGS).select(
        "id", "context", token_count("context").alias("tokens"), "metadata",
        (F.col("turn") % 3).alias("type_id_id"), F.lit(1).alias("application_id_id"))
    return chunking.embedding_update_records(emb, AS_OF)


@register("slug_title", f"""
SELECT p_partkey, k AS key, {D.title("replace(k, '-', ' ')")} AS name
FROM (SELECT p_partkey, replace(lower(p_name || ' ' || p_type || ' 3d-print don''t'), ' ', '-') AS k FROM part)
""")
def q_slug_title(spark, d):
    part = T(spark, d, "part").select(
        "p_partkey", slug_key(F.concat_ws(" ", "p_name", "p_type", F.lit("3d-print don't"))).alias("key"))
    return part.select("p_partkey", "key", title_name("key").alias("name"))


@register("type_key", "SELECT p_partkey, replace(lower(p_type || ' ' || p_brand), ' ', '_') AS key FROM part")
def q_type_key(spark, d):
    return T(spark, d, "part").select("p_partkey", type_key(F.concat_ws(" ", "p_type", "p_brand")).alias("key"))


# --- D1 / D2 / D3 ----------------------------------------------------------------------------------

@register("format_metadata_v1", f"SELECT id, {D.metadata_text_v1('metadata')} AS text FROM ({DUCK_CONTENT})")
def q_format_metadata_v1(spark, d):
    return content(spark, d).select("id", md.metadata_text_v1("metadata").alias("text"))


@register("format_metadata_v2", f"SELECT id, {D.metadata_text_v2('metadata')} AS text FROM ({DUCK_CONTENT})")
def q_format_metadata_v2(spark, d):
    return content(spark, d).select("id", md.metadata_text_v2("metadata").alias("text"))


QUESTION_VALUE = (
    "'{\"q\": ' || CASE turn % 5 WHEN 0 THEN {quoted_q} WHEN 1 THEN {quoted_t} "
    "WHEN 2 THEN '[\"' || role || '\", \"' || role || '?\"]' WHEN 3 THEN CAST(turn AS STRING) ELSE 'null' END || '}'"
)


def _question_value(dialect: str) -> str:
    if dialect == "spark":
        qq = "regexp_extract(to_json(array(replace(text, '.', '?'))), '^\\\\[(.*)\\\\]$', 1)"
        qt = "regexp_extract(to_json(array(text)), '^\\\\[(.*)\\\\]$', 1)"
        return QUESTION_VALUE.replace("{quoted_q}", qq).replace("{quoted_t}", qt)
    return (QUESTION_VALUE.replace("{quoted_q}", "to_json(replace(text, '.', '?'))::VARCHAR")
            .replace("{quoted_t}", "to_json(text)::VARCHAR").replace("AS STRING", "AS VARCHAR"))


@register("clean_questions", f"""
SELECT conv_id, turn, array_to_string({D.clean_meta_list(D.entry(D.entries('v'), 'q'))}, '|') AS questions
FROM (SELECT conv_id, turn, {_question_value('duck')} AS v FROM conversations)
""")
def q_clean_questions(spark, d):
    conv = T(spark, d, "conversations").selectExpr("conv_id", "turn", f"{_question_value('spark')} AS v")
    e = md.entry(md.json_entries(F.col("v")), "q")
    return conv.select("conv_id", "turn", F.array_join(md.clean_meta_list(e), "|").alias("questions"))


# --- D4 / D5 / D6 --------------------------------------------------------------------------------------

def _spark_conv_responses(spark, d):
    conv = TS(spark, d, "conversations")
    return conv.selectExpr("conv_id * 100 + turn AS embedding_id",
                           X.CONV_RESPONSE.replace("{words}", X.SPARK_WORDS) + " AS response")


def _spark_conv_embeddings(spark, d):
    return X.spark_fixture(spark, d, "conversations", X.CONV_EMBEDDINGS)


DUCK_CONV_EMB = X.duck_fixture("conversations", X.CONV_EMBEDDINGS)
DUCK_CONV_RESP = ("SELECT conv_id * 100 + turn AS embedding_id, "
                  + X.CONV_RESPONSE.replace("{words}", X.DUCK_WORDS) + " AS response FROM conversations")


def _duck_enrich() -> str:
    m, r = D.entries("metadata", "km"), D.entries("response", "kr")
    question = (f"CASE WHEN {D.has_key(m, 'question')} THEN 'Question: ' || {D.render(D.entry(m, 'question'))} "
                f"|| chr(10) ELSE '' END")
    ctx = "coalesce(context, 'None')"
    head = (f"CASE WHEN metadata IS NOT NULL THEN {question} || {ctx} || chr(10) || chr(10) || 'Metadata:' || chr(10) "
            f"|| {D.metadata_text_v2('metadata')} || chr(10) || chr(10) ELSE {ctx} || chr(10) || chr(10) END")
    content_ = (f"CASE WHEN {D.has_key(r, 'content')} THEN 'Rephrased Content: ' || "
                f"{D.render(D.entry(r, 'content'))} || chr(10) ELSE '' END")
    questions = (f"CASE WHEN {D.has_key(r, 'questions')} THEN 'Additional Sample Questions: ' || "
                 f"{D.joined_value(D.entry(r, 'questions'))} || chr(10) ELSE '' END")
    keywords = (f"CASE WHEN {D.has_key(r, 'keywords')} THEN 'Keywords: ' || "
                f"{D.joined_value(D.entry(r, 'keywords'))} ELSE '' END")
    new = {k: f"CASE WHEN {D.has_key(r, k)} THEN to_json({D.clean_meta_list(D.entry(r, k))})::VARCHAR END"
           for k in ("questions", "keywords")}
    vj = D.value_json("e")
    for k, js in new.items():
        vj = f"CASE WHEN e.key = '{k}' AND ({js}) IS NOT NULL THEN {js} ELSE {vj} END"
    kept = f"list_transform({m}, lambda e: {{'key': e.key, 'json': {vj}}})"
    extra = " ".join(
        f"|| CASE WHEN ({js}) IS NOT NULL AND NOT ({D.has_key(m, k)}) THEN [{{'key': '{k}', 'json': {js}}}] ELSE [] END"
        for k, js in new.items())
    ents = f"list_concat({kept}, []) {extra}"
    meta = f"'{{' || array_to_string(list_transform({ents}, lambda p: to_json(p.key)::VARCHAR || ':' || p.json), ',') || '}}'"
    return (f"SELECT e.id, e.content_id_id, {head} || {content_} || {questions} || {keywords} AS context, "
            f"{meta} AS metadata, TIMESTAMP '{AS_OF}' AS updated_at "
            f"FROM ({DUCK_CONV_RESP}) r JOIN ({DUCK_CONV_EMB}) e ON r.embedding_id = e.id")


@register("enrich_embeddings", _duck_enrich().replace("lambda e: {'key'", "lambda e: {'key'"))
def q_enrich_embeddings(spark, d):
    enriched, _ = enrichment.enrich_embeddings(_spark_conv_responses(spark, d), _spark_conv_embeddings(spark, d), AS_OF)
    return enriched


@register("unmatched_responses", f"""
SELECT embedding_id FROM ({DUCK_CONV_RESP}) WHERE embedding_id NOT IN (SELECT id FROM ({DUCK_CONV_EMB}) WHERE turn <> 6)
""")
def q_unmatched_responses(spark, d):
    # turn 6 rows are missing from the table: their responses are unmatched
    _, unmatched = enrichment.enrich_embeddings(_spark_conv_responses(spark, d), _spark_conv_embeddings(spark, d).where("turn <> 6"), AS_OF)
    return unmatched.select("embedding_id")


def _spark_merge_rows(spark, d):
    return TS(spark, d, "conversations").selectExpr(
        "conv_id AS content_id", "conv_id * 100 + turn AS id",
        X.CONV_MERGE_METADATA.replace("{words}", X.SPARK_WORDS) + " AS metadata")


def _duck_merge() -> str:
    rows = ("SELECT conv_id AS cid, conv_id * 100 + turn AS ord, "
            + X.CONV_MERGE_METADATA.replace("{words}", X.DUCK_WORDS) + " AS metadata FROM conversations")
    ents = (f"SELECT cid, ord, generate_subscripts(es, 1) AS pos, unnest(es) AS e "
            f"FROM (SELECT cid, ord, {D.entries('metadata')} AS es FROM ({rows}))")
    flat = f"SELECT cid, ord, pos, e.key AS key, e.type AS type, e.raw AS raw, {D.value_json('e')} AS json FROM ({ents})"
    return f"""
WITH ent AS ({flat}),
per_type AS (SELECT cid, key, type, max(ord) AS last_ord FROM ent GROUP BY ALL),
rt AS (SELECT cid, key, arg_max(type, last_ord) AS run_type FROM per_type GROUP BY ALL),
runs AS (SELECT rt.cid, rt.key, rt.run_type,
           (SELECT max(p.last_ord) FROM per_type p WHERE p.cid = rt.cid AND p.key = rt.key AND p.type <> rt.run_type) AS break_ord
         FROM rt),
run AS (SELECT ent.*, runs.run_type FROM ent JOIN runs USING (cid, key)
        WHERE runs.break_ord IS NULL OR ent.ord > runs.break_ord),
sc AS (SELECT cid, key, arg_max(json, ord) AS last_json, count(*) AS members, any_value(run_type) AS run_type
       FROM run GROUP BY ALL),
li AS (SELECT cid, key, '[' || string_agg(item, ',' ORDER BY item) || ']' AS union_json FROM (
         SELECT DISTINCT cid, key, unnest(json_extract(raw, '$[*]'))::VARCHAR AS item FROM run WHERE run_type = 'list')
       GROUP BY ALL),
dp AS (SELECT cid, key, e2.key AS k2, arg_max({D.value_json('e2')}, ord) AS j2, min(ord) AS f_ord,
              arg_min(p2, ord) AS f_pos
       FROM (SELECT cid, key, ord, generate_subscripts(es2, 1) AS p2, unnest(es2) AS e2
             FROM (SELECT cid, key, ord, {D.entries('raw', 'kk')} AS es2 FROM run WHERE run_type = 'dict'))
       GROUP BY ALL),
dj AS (SELECT cid, key, '{{' || string_agg(to_json(k2)::VARCHAR || ':' || j2, ',' ORDER BY f_ord, f_pos) || '}}' AS dict_json
       FROM dp GROUP BY ALL),
fs AS (SELECT cid, key, min(ord) AS first_ord, arg_min(pos, ord) AS first_pos FROM ent GROUP BY ALL),
comb AS (SELECT sc.cid, sc.key, fs.first_ord, fs.first_pos,
           CASE WHEN sc.run_type = 'list' AND sc.members > 1 THEN li.union_json
                WHEN sc.run_type = 'dict' THEN dj.dict_json ELSE sc.last_json END AS json
         FROM sc LEFT JOIN li USING (cid, key) LEFT JOIN dj USING (cid, key) JOIN fs USING (cid, key))
SELECT cid AS id, '{{' || string_agg(to_json(key)::VARCHAR || ':' || json, ',' ORDER BY first_ord, first_pos) || '}}' AS metadata
FROM comb GROUP BY cid
"""


@register("merge_metadata", _duck_merge())
def q_merge_metadata(spark, d):
    return enrichment.merge_metadata_by_content(_spark_merge_rows(spark, d))


@register("merge_metadata_incremental", _duck_merge())
def q_merge_metadata_incremental(spark, d):
    """D5 over rows that arrive in three parts, each folded into the stored
    summaries: first turns 2 and 3, then the later ones, then the first two, which
    come late, so their contents are folded again."""
    rows = _spark_merge_rows(spark, d).withColumn("turn", F.expr("id - content_id * 100"))
    parts = [rows.where(c) for c in ("turn IN (2, 3)", "turn >= 4", "turn < 2")]
    seen, stored = parts[0], enrichment.summarize_metadata(parts[0])
    for part in parts[1:]:
        seen, stored = seen.unionByName(part), stage(stored)
        fresh = stage(enrichment.extend_summaries(stored, part, seen))
        stored = stored.join(fresh, "cid", "left_anti").unionByName(fresh)
    return enrichment.summarized_metadata(stored)


OVERLAY_NEW = (
    "'{\"lang\": \"' || role || '\", \"source\": null, \"turn\": ' || turn || ', \"extra\": [\"' || role || '\"]}'"
)


def _duck_overlay() -> str:
    cur, new = D.entries("cur", "kc"), D.entries("new", "kn")
    kept = (f"list_transform({cur}, lambda e: {{'key': e.key, 'json': coalesce("
            f"(list_transform(list_filter({new}, lambda x: x.key = e.key), lambda x: {D.value_json('x')}))[1], "
            f"{D.value_json('e')})}})")
    added = (f"list_transform(list_filter({new}, lambda x: NOT list_contains(list_transform({cur}, lambda y: y.key), x.key)), "
             f"lambda x: {{'key': x.key, 'json': {D.value_json('x')}}})")
    meta = (f"'{{' || array_to_string(list_transform(list_concat({kept}, {added}), lambda p: "
            f"to_json(p.key)::VARCHAR || ':' || p.json), ',') || '}}'")
    return (f"SELECT n.id, {meta} AS metadata FROM (SELECT conv_id AS id, {OVERLAY_NEW} AS new FROM conversations "
            f") n LEFT JOIN (SELECT id, metadata AS cur FROM ({DUCK_CONTENT})) c ON c.id = n.id")


@register("overlay_metadata", _duck_overlay())
def q_overlay_metadata(spark, d):
    new = T(spark, d, "conversations").selectExpr("conv_id AS id", f"{OVERLAY_NEW} AS metadata")
    return enrichment.overlay_content_metadata(content(spark, d), new)


# --- E1 / G1 / G3 / A7 ------------------------------------------------------------------------------------

@register("assign_batches", """
SELECT l_orderkey, l_linenumber,
  CAST((row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1) // 1000 AS BIGINT) AS batch_no
FROM lineitem
""")
def q_assign_batches(spark, d):
    li = T(spark, d, "lineitem").select(*X.LINE_KEY)
    return tables.assign_batches(li, X.LINE_KEY, 1000).select("l_orderkey", "l_linenumber", "batch_no")


def _line_embeddings(spark, d):
    return X.spark_lines(spark, d).selectExpr(*X.LINE_EMBEDDINGS)


def _order_batches(spark, d):
    return X.spark_fixture(spark, d, "orders", X.ORDER_BATCHES)


DUCK_BATCHED_LINES = (
    "SELECT id, context, CAST((row_number() OVER (ORDER BY id) - 1) // 1000 AS BIGINT) AS batch_no "
    f"FROM ({X.duck_fixture(X.DUCK_LINES, X.LINE_EMBEDDINGS)})")
DUCK_NEW_BATCHES = (
    "SELECT (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY batch_no) AS id, batch_no, "
    "'batch-' || ((SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY batch_no)) AS batch_id, "
    "'embeddings' AS type, false AS is_complete "
    f"FROM (SELECT DISTINCT batch_no FROM ({DUCK_BATCHED_LINES}))")


@register("new_batches", DUCK_NEW_BATCHES)
def q_new_batches(spark, d):
    assigned = tables.assign_batches(_line_embeddings(spark, d).select("id", "context"), ["id"], 1000)
    return lifecycle.create_batches(assigned, _order_batches(spark, d)).select(
        "id", "batch_no", "batch_id", "type", "is_complete")


@register("mark_in_batch", f"""
SELECT e.id, nb.id AS batch_id_id, 'embedding content' AS status
FROM ({X.duck_fixture(X.DUCK_LINES, X.LINE_EMBEDDINGS)}) e JOIN ({DUCK_BATCHED_LINES}) b ON b.id = e.id
JOIN ({DUCK_NEW_BATCHES}) nb ON nb.batch_no = b.batch_no
""")
def q_mark_in_batch(spark, d):
    emb = _line_embeddings(spark, d)
    assigned = stage(tables.assign_batches(emb.select("id"), ["id"], 1000))
    created = lifecycle.create_batches(assigned, _order_batches(spark, d))
    return lifecycle.mark_in_batch(emb, assigned, created).select("id", "batch_id_id", "status")


@register("embedding_requests", """
SELECT CAST((row_number() OVER (ORDER BY id) - 1) // 1000 AS BIGINT) AS batch_no, id,
  json_object('custom_id', 'request-' || id, 'method', 'POST', 'url', '/v1/embeddings',
              'body', json_object('model', 'text-embedding-3-small', 'input', context))::VARCHAR AS line
FROM (SELECT conv_id * 100 + turn AS id, text AS context FROM conversations)
""")
def q_embedding_requests(spark, d):
    emb = X.spark_fixture(spark, d, "conversations", X.CONV_EMBEDDINGS).select("id", "context")
    return files.embedding_requests(tables.assign_batches(emb, ["id"], 1000))


# --- E2 / E3 / E5 / E6 / E4 ---------------------------------------------------------------------

def _spark_keyword_rows(spark, d):
    return TS(spark, d, "conversations").selectExpr(
        "conv_id * 100 + turn AS id", "conv_id AS content_id_id", "turn",
        "'{\"keywords\": ' || " + X.SPARK_KEYWORDS + " || '}' AS metadata")


def _spark_tags(spark, d):
    words = (T(spark, d, "benchmark")
             .select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), 0)).alias("key"))
             .distinct())
    indexed = tables.with_row_index(words, ["key"], "row")
    return indexed.select((F.col("row") + 1).alias("id"), "key", F.col("key").alias("name"))


DUCK_KEYWORDS = ("SELECT conv_id * 100 + turn AS id, conv_id AS content_id, turn, unnest(" + X.DUCK_KEYWORDS
                 + "::JSON::VARCHAR[]) AS keyword FROM conversations")
DUCK_TAGS = ("SELECT row_number() OVER (ORDER BY key) AS id, key, key AS name FROM "
             "(SELECT DISTINCT unnest(regexp_extract_all(lower(text), '\\p{L}+')) AS key FROM benchmark)")
_TAG_NAME = D.title("replace(key, '-', ' ')")
DUCK_NEW_TAGS = (f"SELECT (SELECT max(id) FROM ({DUCK_TAGS})) + row_number() OVER (ORDER BY key) AS id, key, "
                 f"{_TAG_NAME} AS name FROM (SELECT DISTINCT replace(lower(keyword), ' ', '-') AS key "
                 f"FROM ({DUCK_KEYWORDS}) WHERE replace(lower(keyword), ' ', '-') NOT IN (SELECT key FROM ({DUCK_TAGS})))")
DUCK_ALL_TAGS = f"SELECT id, key, name FROM ({DUCK_TAGS}) UNION ALL SELECT id, key, name FROM ({DUCK_NEW_TAGS})"
DUCK_STORED_PAIRS = (f"SELECT DISTINCT k.content_id, t.id AS tag_id FROM ({DUCK_KEYWORDS}) k "
                     f"JOIN ({DUCK_TAGS}) t ON t.key = replace(lower(k.keyword), ' ', '-') WHERE (k.content_id + t.id) % 3 = 0")


def _spark_stored_pairs(spark, d, tag_ids):
    rows = _spark_keyword_rows(spark, d)
    exploded = stage(tags.explode_keywords(rows, id_col="content_id_id", out_id="content_id"))
    existing = _spark_tags(spark, d).select("key", F.col("id").alias("tag_id"))
    return tags.embedding_tag_pairs(exploded.withColumnRenamed("content_id", "embedding_id"), existing) \
        .select(F.col("embedding_id").alias("content_id"), "tag_id").where("(content_id + tag_id) % 3 = 0").distinct()


@register("explode_keywords", f"SELECT id AS embedding_id, keyword FROM ({DUCK_KEYWORDS})")
def q_explode_keywords(spark, d):
    return tags.explode_keywords(_spark_keyword_rows(spark, d))


@register("tags_get_or_create", DUCK_ALL_TAGS)
def q_tags_get_or_create(spark, d):
    existing = _spark_tags(spark, d)
    created, _ = tags.tags_get_or_create(tags.explode_keywords(_spark_keyword_rows(spark, d)), existing)
    return existing.unionByName(created.select("id", "key", "name"))


@register("embedding_tags", f"""
SELECT k.id AS embedding_id, t.id AS tag_id FROM ({DUCK_KEYWORDS}) k
JOIN ({DUCK_ALL_TAGS}) t ON t.key = replace(lower(k.keyword), ' ', '-')
""")
def q_embedding_tags(spark, d):
    exploded = stage(tags.explode_keywords(_spark_keyword_rows(spark, d)))
    _, tag_ids = tags.tags_get_or_create(exploded, _spark_tags(spark, d))
    return tags.embedding_tag_pairs(exploded, tag_ids)


@register("new_content_tags", f"""
SELECT DISTINCT k.content_id, t.id AS tag_id FROM ({DUCK_KEYWORDS}) k
JOIN ({DUCK_ALL_TAGS}) t ON t.key = replace(lower(k.keyword), ' ', '-')
WHERE (k.content_id, t.id) NOT IN (SELECT (content_id, tag_id) FROM ({DUCK_STORED_PAIRS}))
""")
def q_new_content_tags(spark, d):
    rows = _spark_keyword_rows(spark, d)
    exploded = tags.explode_keywords(rows)
    _, tag_ids = tags.tags_get_or_create(exploded, _spark_tags(spark, d))
    merged = enrichment.merge_metadata_by_content(rows.select(F.col("content_id_id").alias("content_id"), "id", "metadata"))
    return tags.new_content_tag_pairs(merged, tag_ids, _spark_stored_pairs(spark, d, tag_ids))


DUCK_TYPE_NAMES = ("SELECT p_type AS name FROM part UNION ALL SELECT event_type FROM events "
                   "UNION ALL SELECT r_name FROM region")
DUCK_TYPES = "SELECT r_regionkey + 1 AS id, replace(lower(r_name), ' ', '_') AS key, r_name AS name FROM region"


@register("types_get_or_create", f"""
SELECT id, key, name FROM ({DUCK_TYPES})
UNION ALL
SELECT (SELECT max(id) FROM ({DUCK_TYPES})) + row_number() OVER (ORDER BY key) AS id, key, name
FROM (SELECT replace(lower(name), ' ', '_') AS key, min(name) AS name FROM ({DUCK_TYPE_NAMES})
      WHERE name IS NOT NULL GROUP BY 1) WHERE key NOT IN (SELECT key FROM ({DUCK_TYPES}))
""")
def q_types_get_or_create(spark, d):
    names = (T(spark, d, "part").select(F.col("p_type").alias("name"))
             .unionByName(T(spark, d, "events").select(F.col("event_type").alias("name")))
             .unionByName(T(spark, d, "region").select(F.col("r_name").alias("name"))))
    existing = T(spark, d, "region").select((F.col("r_regionkey") + 1).cast("bigint").alias("id"),
                                            type_key("r_name").alias("key"), F.col("r_name").alias("name"))
    created, _ = tags.types_get_or_create(names, existing)
    return existing.unionByName(created.select("id", "key", "name"))


# --- A8 / A9 / A10 / A11 ---------------------------------------------------------------------------------

def _customers(spark, d):
    return X.spark_fixture(spark, d, "customer", X.CUSTOMERS)


DUCK_CUSTOMERS = X.duck_fixture("customer", X.CUSTOMERS)


@register("append_rows", f"""
SELECT id, name, acctbal, segment FROM ({DUCK_CUSTOMERS})
UNION ALL
SELECT (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY s_suppkey), s_name, s_acctbal, 'SUPPLIER'
FROM supplier
""")
def q_append_rows(spark, d):
    rows = T(spark, d, "supplier").select("s_suppkey", F.col("s_name").alias("name"),
                                          F.col("s_acctbal").alias("acctbal"), F.lit("SUPPLIER").alias("segment"))
    return tables.append_rows(_customers(spark, d), rows, ["s_suppkey"])


CUSTOMER_UPDATES = [
    "SELECT o_custkey AS id, o_orderkey AS ord, o_totalprice AS acctbal, o_orderpriority AS segment FROM orders",
    "SELECT o_custkey + 1000000 AS id, o_orderkey AS ord, o_totalprice AS acctbal, 'GHOST' AS segment "
    "FROM orders WHERE o_orderstatus = 'P'",
]


@register("update_by_key", f"""
WITH u AS ({CUSTOMER_UPDATES[0]} UNION ALL {CUSTOMER_UPDATES[1]}),
l AS (SELECT id, arg_max(acctbal, ord) AS acctbal, arg_max(segment, ord) AS segment FROM u GROUP BY id)
SELECT c.id, CASE WHEN l.id IS NOT NULL THEN l.acctbal ELSE c.acctbal END AS acctbal,
       CASE WHEN l.id IS NOT NULL THEN l.segment ELSE c.segment END AS segment
FROM ({DUCK_CUSTOMERS}) c LEFT JOIN l ON l.id = c.id
""")
def q_update_by_key(spark, d):
    orders = T(spark, d, "orders")
    orders.createOrReplaceTempView("orders")
    updates = spark.sql(CUSTOMER_UPDATES[0]).unionByName(spark.sql(CUSTOMER_UPDATES[1]))
    return tables.update_by_key(_customers(spark, d), updates, order_col="ord").select("id", "acctbal", "segment")


@register("update_by_content", f"""
SELECT e.id, e.content_id_id, CASE WHEN o.o_orderkey IS NOT NULL THEN 'batch ' || o.o_orderstatus ELSE e.status END AS status
FROM ({X.duck_fixture(X.DUCK_LINES, X.LINE_EMBEDDINGS)}) e LEFT JOIN orders o ON o.o_orderkey = e.content_id_id
""")
def q_update_by_content(spark, d):
    values = T(spark, d, "orders").selectExpr("o_orderkey AS content_id_id", "'batch ' || o_orderstatus AS status")
    return tables.update_by_content(_line_embeddings(spark, d), values, unique=True).select("id", "content_id_id", "status")


@register("delete_by_ids", f"""
SELECT id, name FROM ({DUCK_CUSTOMERS})
WHERE id NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')
""")
def q_delete_by_ids(spark, d):
    ids = T(spark, d, "orders").where("o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'").select("o_custkey")
    return tables.delete_by_ids(_customers(spark, d), ids).select("id", "name")


# --- B2 / B3 / G2 / F1 / G5 / G6 / G7 / G8 / G4 ------------------------------------------------------------

DUCK_ORDER_BATCHES = X.duck_fixture("orders", X.ORDER_BATCHES)


@register("pending_batches", f"""
SELECT id, batch_id, type FROM ({DUCK_ORDER_BATCHES}) WHERE is_complete = false AND type = 'embeddings'
""")
def q_pending_batches(spark, d):
    return lifecycle.pending_batches(_order_batches(spark, d), embeddings_only=True).select("id", "batch_id", "type")


@register("completed_batches", f"""
SELECT b.id, b.batch_id FROM ({DUCK_ORDER_BATCHES}) b JOIN ({X.duck_fixture('orders', X.PROVIDER_STATUS)}) p
  ON p.batch_id = b.batch_id
WHERE b.is_complete = false AND b.type = 'embeddings' AND p.status = 'completed'
""")
def q_completed_batches(spark, d):
    pending = lifecycle.pending_batches(_order_batches(spark, d), embeddings_only=True)
    status = X.spark_fixture(spark, d, "orders", X.PROVIDER_STATUS)
    return lifecycle.completed_at_provider(pending, status).select("id", "batch_id")


DUCK_FLAGGED_ORDERS = "SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'O'"


@register("batch_complete", f"""
SELECT id, CASE WHEN id IN ({DUCK_FLAGGED_ORDERS}) THEN true ELSE is_complete END AS is_complete
FROM ({DUCK_ORDER_BATCHES})
""")
def q_batch_complete(spark, d):
    ids = T(spark, d, "lineitem").where("l_returnflag = 'R' AND l_linestatus = 'O'").select("l_orderkey").distinct()
    return lifecycle.mark_batch_complete(_order_batches(spark, d), ids).select("id", "is_complete")


def _event_embeddings(spark, d):
    return X.spark_fixture(spark, d, "events", X.EVENT_EMBEDDINGS)


DUCK_EVENT_EMB = X.duck_fixture("events", X.EVENT_EMBEDDINGS)
DUCK_COMPLETED = f"""
SELECT content_id_id AS id FROM ({DUCK_EVENT_EMB}) WHERE event_type <> 'click' AND content_id_id IS NOT NULL
GROUP BY content_id_id HAVING count(CASE WHEN status <> 'complete' THEN 1 END) = 0
"""


@register("completed_contents", DUCK_COMPLETED)
def q_completed_contents(spark, d):
    emb = _event_embeddings(spark, d)
    return lifecycle.completed_contents(emb, emb.where("event_type <> 'click'").select("id"))


@register("completed_contents_strict", f"""
SELECT content_id_id AS id FROM ({DUCK_EVENT_EMB})
WHERE content_id_id IN (SELECT content_id_id FROM ({DUCK_EVENT_EMB}) WHERE event_type <> 'click')
GROUP BY content_id_id HAVING count(CASE WHEN status <> 'complete' THEN 1 END) = 0
""")
def q_completed_contents_strict(spark, d):
    emb = _event_embeddings(spark, d)
    return lifecycle.completed_contents(emb, emb.where("event_type <> 'click'").select("id"), strict=True)


@register("content_complete", f"""
SELECT id, CASE WHEN id IN ({DUCK_COMPLETED}) THEN true ELSE is_complete END AS is_complete FROM ({DUCK_CONTENT})
""")
def q_content_complete(spark, d):
    emb = _event_embeddings(spark, d)
    done = lifecycle.completed_contents(emb, emb.where("event_type <> 'click'").select("id"))
    return lifecycle.mark_content_complete(content(spark, d), done).select("id", "is_complete")


DUCK_F_LINES = (f"SELECT * FROM ({X.duck_fixture(X.DUCK_LINES, X.LINE_EMBEDDINGS)}) "
                "WHERE content_id_id IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
DUCK_ATTACHED = (f"SELECT file_id_id AS file_id, link_id_id AS link_id, product_id_id AS product_id, "
                 f"place_id_id AS place_id FROM ({DUCK_F_LINES}) WHERE status = 'complete'")


def _spark_attached(spark, d):
    emb = _line_embeddings(spark, d)
    f_orders = T(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("content_id_id"))
    ids = emb.join(f_orders, "content_id_id", "left_semi").select("id")
    return lifecycle.attachments(emb, ids)


@register("attachments", DUCK_ATTACHED)
def q_attachments(spark, d):
    return _spark_attached(spark, d)


@register("links_processed", f"""
SELECT s_suppkey AS id, CASE WHEN s_suppkey IN (SELECT link_id FROM ({DUCK_ATTACHED}) WHERE link_id IS NOT NULL
  AND link_id <> 0) THEN 'Processed' ELSE 'pending' END AS status FROM supplier
""")
def q_links_processed(spark, d):
    links = T(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.lit("pending").alias("status"))
    return lifecycle.mark_processed(links, _spark_attached(spark, d), "link_id")


@register("files_processed", f"""
SELECT p_partkey AS id, CASE WHEN p_partkey IN (SELECT file_id FROM ({DUCK_ATTACHED}) WHERE file_id IS NOT NULL
  AND file_id <> 0) THEN 'Processed' ELSE 'pending' END AS status FROM part
""")
def q_files_processed(spark, d):
    parts = T(spark, d, "part").select(F.col("p_partkey").alias("id"), F.lit("pending").alias("status"))
    return lifecycle.mark_processed(parts, _spark_attached(spark, d), "file_id")


@register("content_status", f"""
SELECT id, CASE WHEN id IN (SELECT doc_id FROM labels WHERE toxic = 1) THEN 'pending' ELSE status END AS status
FROM ({DUCK_CONTENT})
""")
def q_content_status(spark, d):
    ids = T(spark, d, "labels").where("toxic = 1").select("doc_id")
    return lifecycle.set_content_status(content(spark, d), ids).select("id", "status")


def _vector_text(vec="embedding"):
    """Every component of a vector, in millionths, as one text."""
    return F.array_join(F.transform(vec, lambda x: F.floor(x.cast("double") * 1000000).cast("string")), ",").alias("vector")


def _duck_vector(vec: str) -> str:
    return f"array_to_string(list_transform({vec}, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1000000) AS BIGINT)), ',') AS vector"


@register("apply_embeddings", f"""
WITH v AS (SELECT vec_id AS id, embedding, 0 AS ord FROM embeddings
           UNION ALL SELECT vec_id, list_reverse(embedding), 1 FROM embeddings WHERE label = 0),
l AS (SELECT id, arg_max(embedding, ord) AS embedding FROM v GROUP BY id)
SELECT e.vec_id AS id, CASE WHEN l.id IS NOT NULL THEN 'complete' ELSE 'embedding content' END AS status,
  {_duck_vector("l.embedding")}
FROM embeddings e LEFT JOIN l ON l.id = e.vec_id
""")
def q_apply_embeddings(spark, d):
    emb = T(spark, d, "embeddings")
    target = emb.select(F.col("vec_id").alias("id"), F.lit(None).cast("array<float>").alias("embedding"),
                        F.lit("embedding content").alias("status"), F.lit(None).cast("timestamp").alias("updated_at"))
    ts = F.lit(AS_OF).cast("timestamp")
    vectors = (emb.select(F.col("vec_id").alias("id"), "embedding", F.lit(0).alias("ord"))
               .unionByName(emb.where("label = 0").select(F.col("vec_id").alias("id"),
                                                          F.reverse("embedding").alias("embedding"), F.lit(1).alias("ord")))
               .withColumn("status", F.lit("complete")).withColumn("updated_at", ts))
    return lifecycle.apply_embeddings(target, vectors, order_col="ord").select("id", "status", _vector_text())


# --- A5 / A6 / A6b: result lines (built from the tables, parsed as files would be) ----------------------------

def _json_str(x: str, dialect: str) -> str:
    if dialect == "spark":
        return f"regexp_extract(to_json(array({x})), '^\\\\[(.*)\\\\]$', 1)"
    return f"to_json({x})::VARCHAR"


def _enrichment_line(dialect: str) -> str:
    resp = "'{\"content\": \"' || role || '\", \"keywords\": [\"' || role || '\", \"k' || turn || '\"]}'"
    ok = ("'{\"custom_id\": \"request-' || (conv_id * 100 + turn) || '\", \"response\": {\"status_code\": 200, "
          "\"body\": {\"choices\": [{\"message\": {\"content\": ' || " + _json_str(resp, dialect) + " || '}}]}}, "
          "\"error\": null}'")
    return ("CASE WHEN turn = 3 THEN 'not json' WHEN turn = 6 THEN '' "
            "WHEN turn = 4 THEN '{\"custom_id\": \"request-x' || conv_id || '\", \"response\": {\"body\": "
            "{\"choices\": [{\"message\": {\"content\": \"{}\"}}]}}}' "
            "WHEN turn = 1 AND conv_id % 2 = 0 THEN '{\"custom_id\": \"request-' || (conv_id * 100 + turn) || "
            "'\", \"response\": null, \"error\": {\"message\": \"failed\"}}' "
            "WHEN turn = 2 THEN replace(" + ok + ", '\"request-', '\"request-7-') "
            "ELSE " + ok + " END")


@register("parse_enrichment_output", f"""
SELECT CAST(tail AS BIGINT) AS embedding_id, content AS response FROM (
  SELECT regexp_extract(json_extract_string(line, '$.custom_id'), '[^-]*$') AS tail,
         json_extract_string(line, '$.response.body.choices[0].message.content') AS content
  FROM (SELECT {_enrichment_line('duck')} AS line FROM conversations) WHERE line <> '' AND json_valid(line))
WHERE regexp_matches(tail, '^[0-9]+$') AND content IS NOT NULL AND json_valid(content) AND json_type(content) = 'OBJECT'
""")
def q_parse_enrichment_output(spark, d):
    lines = T(spark, d, "conversations").selectExpr(f"{_enrichment_line('spark')} AS line", "'conversations' AS file_path", "conv_id * 100 + turn AS line_order")
    good, _ = files.parse_enrichment_lines(lines.where("line <> ''"))
    return good.drop("line_order")


@register("enrichment_bad_lines", f"""
SELECT id, line FROM (
  SELECT id, line, CASE WHEN json_valid(line) THEN regexp_extract(json_extract_string(line, '$.custom_id'), '[^-]*$') END AS tail,
         CASE WHEN json_valid(line) THEN json_extract_string(line, '$.response.body.choices[0].message.content') END AS content
  FROM (SELECT conv_id * 100 + turn AS id, {_enrichment_line('duck')} AS line FROM conversations) WHERE line <> '')
WHERE coalesce(NOT (regexp_matches(tail, '^[0-9]+$') AND json_valid(content) AND json_type(content) = 'OBJECT'), true)
""")
def q_enrichment_bad_lines(spark, d):
    """A5's quarantine: every line that gives no response."""
    lines = T(spark, d, "conversations").selectExpr(
        f"{_enrichment_line('spark')} AS line", "CAST(conv_id * 100 + turn AS STRING) AS file_path", "conv_id * 100 + turn AS line_order")
    _, bad = files.parse_enrichment_lines(lines.where("line <> ''"))
    return bad.select(F.col("file_path").cast("bigint").alias("id"), "line")


def _embedding_line(dialect: str) -> str:
    vec = "to_json(embedding)" + ("" if dialect == "spark" else "::VARCHAR")
    body = lambda v, cid: ("'{\"custom_id\": \"request-' || " + cid + " || '\", \"response\": {\"status_code\": 200, "
                           "\"body\": {\"data\": [{\"embedding\": ' || " + v + " || '}]}}}'")
    return ("CASE WHEN label = 9 THEN '{\"custom_id\": \"request-' || vec_id || '\", \"response\": null, "
            "\"error\": {\"message\": \"x\"}}' "
            f"WHEN label = 3 THEN {body(_json_str(vec, dialect), 'vec_id')} "
            f"WHEN label = 7 THEN {body(vec, 'vec_id || ' + repr('-9').replace(chr(39), chr(39)))} "
            f"ELSE {body(vec, 'vec_id')} END")


def _duck_vectors(piece: str) -> str:
    line = _embedding_line("duck")
    return f"""
SELECT CAST(tail AS BIGINT) AS id, CAST(CASE WHEN json_type(v) = 'VARCHAR' THEN json_extract_string(v, '$')::JSON
                                             ELSE v END AS FLOAT[]) AS embedding
FROM (SELECT {piece} AS tail, json_extract(line, '$.response.body.data[0].embedding') AS v
      FROM (SELECT {line} AS line FROM embeddings))
WHERE regexp_matches(tail, '^[0-9]+$') AND v IS NOT NULL
"""


@register("parse_embedding_output", f"""
SELECT id, 'complete' AS status, {_duck_vector("embedding")}
FROM ({_duck_vectors("regexp_extract(json_extract_string(line, '$.custom_id'), '[^-]*$')")})
""")
def q_parse_embedding_output(spark, d):
    lines = T(spark, d, "embeddings").selectExpr(f"{_embedding_line('spark')} AS line", "'embeddings' AS file_path", "vec_id AS line_order")
    good, _ = files.parse_embedding_lines(lines, AS_OF)
    return good.select("id", "status", _vector_text())


@register("parse_embedding_output_table", f"""
SELECT id, true AS is_complete, {_duck_vector("embedding")}
FROM ({_duck_vectors("string_split(json_extract_string(line, '$.custom_id'), '-')[2]")})
""")
def q_parse_embedding_output_table(spark, d):
    lines = T(spark, d, "embeddings").selectExpr(f"{_embedding_line('spark')} AS line", "'embeddings' AS file_path", "vec_id AS line_order")
    good, _ = files.parse_embedding_lines_table(lines)
    return good.select("id", "is_complete", _vector_text())


# --- S1: the stage-1 stream over the documents table ---------------------------------------------

@register("stream_chunks", _duck_recursive_records("text"))
def q_stream_chunks(spark, d):
    """S1 with ``availableNow``: the documents table (one file, or a folder of
    them) flows through normalize + recursive chunking into a parquet sink in the
    shared checkpoint folder; the result is that sink's table."""
    import uuid

    from docweave.session import ensure_checkpoint_dir
    from docweave.streaming.jobs import stream_chunks

    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream_chunks-{uuid.uuid4().hex}"
    docs, columns = T(spark, d, "documents"), ["doc_id AS id", "text AS content"]
    # a stream takes a single file by a glob only; this one matches the file or the folder
    q = stream_chunks(spark, f"{d}/documents.parque[t]", docs.schema, f"{root}/chunks", f"{root}/ckpt", columns=columns)
    q.awaitTermination()
    return spark.read.schema(preprocess_job(docs.selectExpr(*columns)).schema).parquet(f"{root}/chunks")


@register("embedding_records_recursive", _duck_embedding_records(recursive=True))
def q_embedding_records_recursive(spark, d):
    """C6 with the reference's recursive splitter (the oracle-checked
    ``embedding_records`` uses the native window splitter)."""
    return chunking.embedding_records(content(spark, d), AS_OF, splitter="recursive")


# --- A4: tabular files (written from the tables, read back) -------------------------

def _scratch(spark, name):
    import uuid

    from docweave.session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# cells with quotes, commas, line breaks and the marks pandas reads as missing
_CELL = ("CASE c_custkey % 5 WHEN 0 THEN 'say \"hi\", ' || c_name WHEN 1 THEN c_name || chr(10) || 'second line' "
         "WHEN 2 THEN 'NA' WHEN 3 THEN '' ELSE c_name END")


@register("read_tabular", f"""
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, coalesce(c_name, '') AS c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CAST(c_acctbal AS VARCHAR) AS c_acctbal, coalesce(c_mktsegment, '') AS c_mktsegment,
       CASE c_custkey % 5 WHEN 2 THEN '' ELSE {_CELL} END AS note
FROM customer
""")
def q_read_tabular(spark, d):
    """The customer table written as CSV files (with a leading unnamed index
    column, quoted as pandas quotes), then read by A4."""
    path = _scratch(spark, "tabular")
    cust = T(spark, d, "customer").selectExpr("'' AS `Unnamed: 0`", "*", f"{_CELL} AS note")
    cust.write.option("header", True).option("escape", '"').csv(path)
    return files.read_tabular(spark, path, "csv")


@register("read_tabular_json", f"""
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, coalesce(CASE c_custkey % 5 WHEN 3 THEN NULL ELSE {_CELL} END, '') AS note FROM customer
""")
def q_read_tabular_json(spark, d):
    """The same from JSON records, one to a line (files are split)."""
    path = _scratch(spark, "tabular")
    cust = T(spark, d, "customer").selectExpr("c_custkey", f"CASE c_custkey % 5 WHEN 3 THEN NULL ELSE {_CELL} END AS note")
    cust.write.json(path)
    return files.read_tabular(spark, path, "json", multi_line=False)


# --- last line wins, through files of unequal size and the job's own path -----------------------

@register("last_line_wins", f"""
SELECT vec_id AS id, 'complete' AS status, {_duck_vector("CASE WHEN vec_id % 3 = 0 THEN list_reverse(embedding) ELSE embedding END")} FROM embeddings
""")
def q_last_line_wins(spark, d):
    """A line for every vector in a first file, a second line for every third in
    a later, smaller one, read by A6 and applied by the completion job."""
    path = _scratch(spark, "lines")
    emb = T(spark, d, "embeddings")
    line = ("'{{\"custom_id\": \"request-' || vec_id || '\", \"response\": {{\"body\": {{\"data\": [{{\"embedding\": ' || to_json({v}) || '}}]}}}}}}' AS value")
    emb.selectExpr(line.format(v="embedding")).write.text(f"{path}/run=1")
    emb.where("vec_id % 3 = 0").selectExpr(line.format(v="reverse(embedding)")).write.text(f"{path}/run=2")
    vectors, _ = files.read_embedding_output(spark, path, AS_OF)
    out = complete_job(vectors, *_completion_tables(spark, d), AS_OF)
    return out.embeddings.select("id", "status", _vector_text())


# --- S2 / S3: the stage-2 and stage-3 streams over result lines built from the tables -----------

def _completion_tables(spark, d):
    """(embeddings, batches, batch_ids, content, links, files) for the completion job."""
    target = T(spark, d, "embeddings").selectExpr(
        "vec_id AS id", "CAST(label AS BIGINT) AS content_id_id", "'embedding content' AS status",
        "CASE WHEN vec_id % 3 = 0 THEN CAST(label + 1 AS BIGINT) END AS link_id_id", "CAST(label AS BIGINT) AS file_id_id",
        "CAST(NULL AS BIGINT) AS product_id_id", "CAST(NULL AS BIGINT) AS place_id_id",
        "CAST(NULL AS BIGINT) AS batch_id_id", "CAST(NULL AS ARRAY<FLOAT>) AS embedding",
        "CAST(NULL AS TIMESTAMP) AS updated_at")
    batches = _order_batches(spark, d)
    return (target, batches, lifecycle.pending_batches(batches, embeddings_only=True).select("id"),
            content(spark, d).select("id", "is_complete", "status"),
            T(spark, d, "supplier").selectExpr("s_suppkey AS id", "'pending' AS status"),
            T(spark, d, "part").selectExpr("p_partkey AS id", "'pending' AS status"))


# result lines without the odd ids of label 7 (a line for another row)
_STREAM_LINE = {e: _embedding_line(e).replace("WHEN label = 7 ", "WHEN label = -7 ") for e in ("spark", "duck")}


@register("stream_completion", f"""
WITH v AS (SELECT vec_id, label, embedding FROM embeddings WHERE label <> 9),
out AS (
  SELECT 'embeddings' AS tbl, e.vec_id AS id, CASE WHEN v.vec_id IS NULL THEN 'embedding content' ELSE 'complete ' || vector END AS value
  FROM embeddings e LEFT JOIN (SELECT vec_id, {_duck_vector("embedding")} FROM v) v ON v.vec_id = e.vec_id
  UNION ALL SELECT 'batches', id, CASE WHEN type = 'embeddings' THEN 'true' ELSE CAST(is_complete AS VARCHAR) END FROM ({DUCK_ORDER_BATCHES})
  UNION ALL SELECT 'content', doc_id, CASE WHEN doc_id IN (SELECT label FROM v) THEN 'true' ELSE 'false' END FROM documents
  UNION ALL SELECT 'links', s_suppkey, CASE WHEN s_suppkey IN (SELECT label + 1 FROM v WHERE vec_id % 3 = 0) THEN 'Processed' ELSE 'pending' END FROM supplier
  UNION ALL SELECT 'files', p_partkey, CASE WHEN p_partkey IN (SELECT label FROM v WHERE label <> 0) THEN 'Processed' ELSE 'pending' END FROM part
  UNION ALL SELECT 'bad_lines', vec_id, {_STREAM_LINE['duck']} FROM embeddings WHERE label = 9)
SELECT tbl, CAST(id AS BIGINT) AS id, value FROM out
""")
def q_stream_completion(spark, d):
    """S3 in three epochs: one result line per row of ``embeddings`` (some
    errored, some string-encoded) lands in three folders of files. Returns all
    tables with the stream's changes, and the lines that could not be used. A
    content (label) is finished by its last vector."""
    from docweave.streaming import completion

    root = _scratch(spark, "stream_completion")
    lines = T(spark, d, "embeddings").selectExpr(f"{_STREAM_LINE['spark']} AS value", "vec_id % 3 AS part")
    lines.write.partitionBy("part").text(f"{root}/lines")
    target, batches, batch_ids, contents, links, file_table = _completion_tables(spark, d)
    for k in range(3):
        completion.stream_completion(spark, f"{root}/lines/part=[0-{k}]", target, f"{root}/out", f"{root}/ckpt", AS_OF)[1].awaitTermination()
    tables_now = completion.completion_tables(spark, f"{root}/out", target, batches, batch_ids, contents, links, file_table)
    value = {"embeddings": F.concat_ws(" ", "status", F.when(F.col("embedding").isNotNull(), _vector_text())), "batches": F.col("is_complete").cast("string"),
             "content": F.col("is_complete").cast("string"), "links": F.col("status"), "files": F.col("status")}
    bad = completion.bad_lines(spark, f"{root}/out")
    out = bad.select(F.lit("bad_lines").alias("tbl"), F.regexp_extract("line", "request-([0-9]+)", 1).cast("bigint").alias("id"), F.col("line").alias("value"))
    for name, v in value.items():
        out = out.unionByName(vars(tables_now)[name].select(F.lit(name).alias("tbl"), F.col("id").cast("bigint").alias("id"), v.alias("value")))
    return out


# one response per turn, with list keywords: every output of the job has a short SQL form
_S2_RESPONSE = "'{\"content\": \"' || role || '\", \"keywords\": [\"' || upper(role) || '\", \"K ' || turn || '\"]}'"


def _s2_line(dialect: str) -> str:
    return ("CASE WHEN turn = 3 THEN 'not json ' || (conv_id * 100 + turn) ELSE '{\"custom_id\": \"request-' || (conv_id * 100 + turn) || "
            "'\", \"response\": {\"body\": {\"choices\": [{\"message\": {\"content\": ' || " + _json_str(_S2_RESPONSE, dialect) + " || '}}]}}}' END")


def _duck_stream_enrichment() -> str:
    e = f"({DUCK_CONV_EMB})"
    base_id = "(SELECT max(o_orderkey) FROM orders)"
    head = (f"CASE WHEN metadata IS NOT NULL THEN CASE WHEN role = 'system' THEN 'Question: Who is ' || role || '?' || chr(10) ELSE '' END "
            f"|| context || chr(10) || chr(10) || 'Metadata:' || chr(10) || {D.metadata_text_v2('metadata')} || chr(10) || chr(10) "
            "ELSE context || chr(10) || chr(10) END")
    meta = ("CASE WHEN metadata IS NULL THEN '{' ELSE replace(left(metadata, length(metadata) - 1), '\": ', '\":') || ',' END "
            "|| '\"keywords\":[\"' || upper(role) || '\",\"K ' || turn || '\"]}'")
    return f"""
WITH r AS (SELECT *, {head} || 'Rephrased Content: ' || role || chr(10) || 'Keywords: ' || upper(role) || ' K ' || turn AS ctx,
                  replace({meta}, ', \"', ',\"') AS meta, CAST((row_number() OVER (ORDER BY id) - 1) // 1000 AS BIGINT) AS batch_no
           FROM {e} WHERE turn <> 3),
kw AS (SELECT id, content_id_id, replace(lower(k), ' ', '-') AS key FROM (SELECT id, content_id_id, unnest([upper(role), 'K ' || turn]) AS k FROM r)),
tag AS ({DUCK_TAGS}),
fresh AS (SELECT (SELECT max(id) FROM tag) + row_number() OVER (ORDER BY key) AS id, key, {_TAG_NAME} AS name
          FROM (SELECT DISTINCT key FROM kw WHERE key NOT IN (SELECT key FROM tag))),
allt AS (SELECT id, key FROM tag UNION ALL SELECT id, key FROM fresh),
out AS (
  SELECT 'embeddings' AS tbl, e.id, CASE WHEN r.id IS NULL THEN e.context || '|add to batch' ELSE r.ctx || '|' || r.meta || '|embedding content|' || ({base_id} + 1 + r.batch_no) END AS value
  FROM {e} e LEFT JOIN r ON r.id = e.id
  UNION ALL SELECT 'tags', id, key || '|' || name FROM fresh
  UNION ALL SELECT 'embedding_tags', kw.id, CAST(allt.id AS VARCHAR) FROM kw JOIN allt USING (key)
  UNION ALL SELECT DISTINCT 'content_tags', kw.content_id_id, CAST(allt.id AS VARCHAR) FROM kw JOIN allt USING (key)
  UNION ALL SELECT 'batches', id, CASE WHEN type = 'embeddings' THEN 'true' ELSE CAST(is_complete AS VARCHAR) END FROM ({DUCK_ORDER_BATCHES})
  UNION ALL SELECT DISTINCT 'batches', {base_id} + 1 + batch_no, 'false' FROM r
  UNION ALL SELECT 'requests', id, json_object('custom_id', 'request-' || id, 'method', 'POST', 'url', '/v1/embeddings',
              'body', json_object('model', 'text-embedding-3-small', 'input', ctx))::VARCHAR FROM r
  UNION ALL SELECT 'bad_lines', conv_id * 100 + turn, 'not json ' || (conv_id * 100 + turn) FROM conversations WHERE turn = 3)
SELECT tbl, CAST(id AS BIGINT) AS id, value FROM out
"""


@register("stream_enrichment", _duck_stream_enrichment())
def q_stream_enrichment(spark, d):
    """S2 with ``availableNow``: chat result lines built from every conversation
    turn land as text files; the stream parses them and runs the enrichment job
    on the stored tables. Returns every table and output it wrote."""
    from docweave.streaming import jobs
    from docweave.streaming.store import EpochTables

    root = _scratch(spark, "stream_enrichment")
    T(spark, d, "conversations").selectExpr(f"{_s2_line('spark')} AS value").write.text(f"{root}/lines")
    ts = ["CAST(NULL AS TIMESTAMP) AS created_at", "CAST(NULL AS TIMESTAMP) AS updated_at"]
    store = EpochTables(spark, f"{root}/tables", jobs.ENRICHMENT_TABLES)
    store.create("embeddings", _spark_conv_embeddings(spark, d).selectExpr(
        "id", "content_id_id", "context", "metadata", "'add to batch' AS status", "CAST(NULL AS BIGINT) AS batch_id_id", ts[1]))
    store.create("content", content(spark, d).select("id", "metadata", "is_complete", "status"))
    store.create("tags", _spark_tags(spark, d).selectExpr("*", *ts))
    store.create("content_tags", spark.createDataFrame([], "content_id long, tag_id long"))
    store.create("batches", _order_batches(spark, d).selectExpr("*", *ts))
    q = jobs.stream_enrichment(spark, f"{root}/lines", store, lambda t: lifecycle.pending_batches(t["batches"], embeddings_only=True).select("id"),
                               f"{root}/ckpt", AS_OF)
    q.awaitTermination()

    def written(name):
        return spark.read.parquet(f"{root}/tables/{name}/epoch=0")

    done = F.col("status") == "embedding content"
    parts = {
        "embeddings": store.read("embeddings").select("id", F.when(done, F.concat_ws("|", "context", "metadata", "status", F.col("batch_id_id").cast("string")))
                                                      .otherwise(F.concat_ws("|", "context", "status")).alias("value")),
        "tags": written("tags").select("id", F.concat_ws("|", "key", "name").alias("value")),
        "embedding_tags": written("embedding_tags").select(F.col("embedding_id").alias("id"), F.col("tag_id").cast("string").alias("value")),
        "content_tags": store.read("content_tags").select(F.col("content_id").alias("id"), F.col("tag_id").cast("string").alias("value")),
        "batches": store.read("batches").select("id", F.col("is_complete").cast("string").alias("value")),
        "requests": written("requests").select("id", F.col("line").alias("value")),
        "bad_lines": written("bad_lines").select(F.regexp_extract("line", "[0-9]+", 0).cast("bigint").alias("id"), F.col("line").alias("value"))}
    out = None
    for name, rows in parts.items():
        one = rows.select(F.lit(name).alias("tbl"), F.col("id").cast("bigint").alias("id"), "value")
        out = one if out is None else out.unionByName(one)
    return out
