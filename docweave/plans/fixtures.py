"""Pipeline tables derived from the driver's tables.

The reference works on content / embedding / batch / tag tables; the
driver provides TPC-H-like tables and documents. Each fixture below is one
SQL expression list that both Spark (``selectExpr``) and DuckDB run, so the
Spark query and its oracle start from identical rows. Dirty text is added
on purpose: the driver's documents contain no control characters, HTML,
curly quotes or hyphen breaks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

AS_OF = "2024-06-01 00:00:00"

# Text appended to every document so normalization has work to do
# (U+0301 after "e", CRLF, CR, control characters, hyphen breaks, curly
# quotes and dashes, tabs, blank lines with spaces, NBSP, and HTML on half
# of the rows).
DIRTY_TEXT = (
    "text || ' cafe' || '́' || chr(13) || chr(10) || 'line' || chr(13) || 'x' || chr(1) || chr(31)"
    " || ' wörd-' || chr(10) || 'ébc a-' || chr(10) || 'b-' || chr(10) || 'c “q” ‘s’ — – '"
    " || chr(9) || chr(9) || ' sp' || chr(10) || ' ' || chr(10) || ' ' || chr(10) || chr(10) || chr(10)"
    " || 'end' || chr(160) || chr(10)"
    " || CASE WHEN n_chars % 2 = 0 THEN '<p>para</p><a href=\"http://h/' || doc_id || '\">link</a>' ELSE '' END"
    " || '  '"
)

PAGE_EXTRA = (
    "html || '<noscript>ns</noscript><img src=\"a.png\" alt=\"Alt text\"><img src=\"b.png\">"
    "<p>x &lt; y &gt; z &amp; &quot;q&quot;&nbsp;</p><a href=\"/n\"><b>nested</b></a>"
    "<a href=' || chr(39) || '/s' || chr(39) || '>single</a><a class=c href=/bare>bare</a>"
    "<a href = \"/w\">' || repeat(' ', 300) || 'wide' || repeat(' ', 300) || '</a><img src=c alt=' || chr(39) || 'one two' || chr(39)"
    " || '><img alt=word src=d>&mdash;&#8217;&eacute;&#xE9;&amp;lt;' || CASE WHEN page_id % 40 = 0 THEN repeat('<br>', 100000) ELSE '' END"
    " || CASE WHEN page_id % 3 = 0 THEN 'end<script>never(closed' ELSE 'end' END"
)

CONTENT_METADATA = (
    "CASE WHEN lang = 'es' THEN NULL ELSE "
    "'{\"id\": ' || doc_id || ', \"lang\": \"' || lang || '\", \"source\": \"' || source || '\", "
    "\"n_chars\": ' || n_chars || ', \"url\": \"http://example.org/' || doc_id || '\", "
    "\"tags\": [\"' || lang || '\", \"' || source || '\"], "
    "\"info\": {\"lang\": \"' || lang || '\", \"blank\": \"\", \"link\": \"http://x\", \"id\": 1, \"size\": ' || n_chars || '}, "
    "\"reviewed\": ' || CASE WHEN n_chars % 2 = 0 THEN 'true' ELSE 'false' END || ', \"note\": null, \"empty\": \"\"'"
    " || CASE WHEN n_chars % 5 = 0 THEN ', \"extra\": []' ELSE '' END"
    " || CASE WHEN n_chars % 7 = 0 THEN ', \"people\": [{\"name\": \"' || source || '\", \"id\": 2}, {\"role\": \"' || lang || '\"}]' ELSE '' END"
    " || CASE WHEN n_chars % 3 = 0 THEN ', \"question\": \"What is ' || source || '?\"' ELSE '' END"
    " || '}' END"
)

CONTENT = [
    "doc_id AS id", "text AS content", f"{CONTENT_METADATA} AS metadata", "false AS is_complete",
    "n_chars % 4 AS type_id", "doc_id % 50 AS user_id_id", "1 AS application_id_id", "'active' AS status",
]

# conversations as embedding rows (id = conv_id * 100 + turn, content = conv_id)
CONV_EMBEDDINGS = [
    "conv_id * 100 + turn AS id", "conv_id AS content_id_id", "text AS context",
    "CASE WHEN turn = 5 THEN NULL ELSE '{\"role\": \"' || role || '\", \"turn\": ' || turn"
    " || CASE WHEN role = 'system' THEN ', \"question\": \"Who is ' || role || '?\"' ELSE '' END"
    " || ', \"url\": \"http://c/' || conv_id || '\"}' END AS metadata",
    "role", "turn",
]

# model responses for those rows ({words} is the engine's JSON list of words)
CONV_RESPONSE = (
    "'{\"content\": \"' || upper(role) || ' reply ' || turn || '\"'"
    " || CASE turn % 3 WHEN 0 THEN ', \"questions\": [\"Why ' || role || '?\", \"How?\"]'"
    "   WHEN 1 THEN ', \"questions\": \"What is ' || role || '? Where?, When\"' ELSE '' END"
    " || CASE turn % 4 WHEN 0 THEN ', \"keywords\": ' || {words}"
    "   WHEN 1 THEN ', \"keywords\": \"' || role || ' keyword\"'"
    "   WHEN 2 THEN ', \"keywords\": {\"' || role || '\": 1, \"Turn ' || turn || '\": 2}' ELSE '' END"
    " || '}'"
)

# metadata rows for the per-content merge
CONV_MERGE_METADATA = (
    "'{\"role\": \"' || role || '\", \"turn\": ' || turn || ', \"words\": ' || {words}"
    " || ', \"info\": {\"' || role || '\": ' || turn || ', \"last\": \"' || role || '\"}'"
    " || ', \"flag\": ' || CASE WHEN turn % 2 = 0 THEN 'true' ELSE '1' END"
    " || ', \"mix\": ' || CASE turn % 3 WHEN 0 THEN '\"s' || turn || '\"' WHEN 1 THEN 'null'"
    "   ELSE '[\"m' || turn || '\", \"m0\"]' END"
    " || CASE WHEN turn = 1 THEN ', \"late\": [1, 1]' ELSE '' END || '}'"
)

SPARK_WORDS = "to_json(regexp_extract_all(lower(text), '\\\\p{L}+', 0))"
DUCK_WORDS = "to_json(regexp_extract_all(lower(text), '\\p{L}+'))::VARCHAR"
SPARK_KEYWORDS = ("to_json(concat(regexp_extract_all(lower(text), '\\\\p{L}+', 0), "
                  "array(upper(role) || ' Topic', lower(role) || ' topic')))")
DUCK_KEYWORDS = ("to_json(list_concat(regexp_extract_all(lower(text), '\\p{L}+'), "
                 "[upper(role) || ' Topic', lower(role) || ' topic']))::VARCHAR")

# orders as batch rows; provider status per external batch id
ORDER_BATCHES = [
    "o_orderkey AS id", "'ob-' || o_orderkey AS batch_id",
    "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'chat' ELSE 'embeddings' END AS type",
    "o_orderstatus = 'F' AS is_complete",
]
PROVIDER_STATUS = [
    "'ob-' || o_orderkey AS batch_id",
    "CASE WHEN o_orderstatus = 'O' THEN 'completed' ELSE 'in_progress' END AS status",
]

# lineitem rows as embeddings with attachments
LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]  # unique in lineitem
LINE_EMBEDDINGS = [
    "line_id AS id", "l_orderkey AS content_id_id",
    "CASE WHEN l_linestatus = 'F' THEN 'complete' ELSE 'embedding content' END AS status",
    "CASE WHEN l_returnflag = 'R' THEN l_partkey WHEN l_returnflag = 'A' THEN 0 ELSE NULL END AS file_id_id",
    "CASE WHEN l_quantity > 25 THEN l_suppkey ELSE NULL END AS link_id_id",
    "l_partkey AS product_id_id", "CAST(NULL AS BIGINT) AS place_id_id",
    "CAST(NULL AS BIGINT) AS batch_id_id",
    "l_returnflag || ' ' || l_linestatus || ' ' || l_shipdate AS context",
]

# events as embeddings: user = content, statuses from event type and value
EVENT_EMBEDDINGS = [
    "event_id AS id", "user_id AS content_id_id",
    "CASE WHEN event_type = 'error' THEN NULL"
    " WHEN event_type = 'signup' AND value > 250 THEN 'embedding content'"
    " WHEN event_type = 'click' AND value > 200 THEN 'embedding content' ELSE 'complete' END AS status",
    "event_type",
]

CUSTOMERS = ["c_custkey AS id", "c_name AS name", "c_acctbal AS acctbal", "c_mktsegment AS segment"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spark_fixture(spark: SparkSession, sf_dir: str, name: str, exprs: list[str]) -> DataFrame:
    return table(spark, sf_dir, name).selectExpr(*exprs)


def duck_fixture(name: str, exprs: list[str]) -> str:
    return f"SELECT {', '.join(exprs)} FROM {name}"


def spark_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with ``line_id``: 0-based position in (order, line, part, supplier) order."""
    from docweave.operators.tables import with_row_index
    return with_row_index(table(spark, sf_dir, "lineitem"), LINE_KEY, "line_id")


DUCK_LINES = ("(SELECT *, row_number() OVER (ORDER BY " + ", ".join(LINE_KEY)
              + ") - 1 AS line_id FROM lineitem)")
