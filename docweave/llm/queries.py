"""The registered queries of the operators, with SQL where SQL can express them.

Every query applies its operator with production parameters to whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm import (
    decontaminate,
    exact_dedup,
    forest,
    mixing,
    packing,
    periodic_runs,
    prefix_trie,
    quality,
    simhash,
    suffix_dedup,
    token_counts,
    toxicity,
    warc,
)
from docweave.llm.common import table

LENGTH = 4096


def word_vocab() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_vocab() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(F.col("id").alias("doc_id"), F.coalesce(toxicity.is_held_out("id"), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= toxicity.DECISION).cast("int").alias("predicted"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.attribute(table(spark, sf_dir, "documents"), *byte_vocab())
    return counts.select(F.col("id").alias("doc_id"), F.col("section").alias("line"), F.col("start").alias("start_char"),
                         F.col("end").alias("end_char"), "tokens", "crossing")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, _ = mixing.mix(table(spark, sf_dir, "documents"))
    return documents.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derive(warc.response_records(table(spark, sf_dir, "pages"))).withColumnRenamed("id", "page_id")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.fit_and_score(docs, table(spark, sf_dir, "labels"))
    return scored.select(F.col("id").alias("doc_id"), F.coalesce(toxicity.is_held_out("id"), F.lit(False)).alias("held_out"),
                         "text_score", "meta_score", "score", "good")


def op6_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.near_duplicates(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), word_vocab(), LENGTH)
    return pieces.select(F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.drop_repeats(table(spark, sf_dir, "documents"), with_text=False)
    return found.withColumnRenamed("id", "doc_id")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = prefix_trie.turn_lists(table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(prefix_trie.shared_starts(lists))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    planted = docs.withColumn("text", periodic_runs.planted_text(F.col("text"), F.col("doc_id")))
    return periodic_runs.periodic_runs(planted).withColumnRenamed("id", "doc_id")


def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hits.select(F.col("id").alias("doc_id"), "n_words", decontaminate.hit_words().alias("n_hit"),
                       F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                       (F.size("spans") > 0).alias("contaminated"))


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_token_counts, op3_mixing, op4_warc, op5_quality, op6_forest, op7_simhash,
                                     op8_packing, op9_suffix_dedup, op10_exact_dedup, op11_prefix_trie, op12_periodic_runs, op13_decontaminate)}

ORACLES: dict[str, str] = {
    "op10_exact_dedup": r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS h
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       row_number() OVER w = 1 AS kept, h AS text_sha256
FROM d WINDOW w AS (PARTITION BY h ORDER BY n DESC, doc_id NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
""",
    "op3_mixing": r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS h, text FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size,
              row_number() OVER (ORDER BY source COLLATE "binary" NULLS LAST) - 1 AS no FROM d GROUP BY source),
s1 AS (SELECT *, (no % 3 + 1)::DOUBLE AS w, source_size * 3.0::DOUBLE AS most, source_size * 3.0::DOUBLE / (no % 3 + 1)::DOUBLE AS lv FROM s0),
s2 AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY lv, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY lv, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS share FROM s1),
s3 AS (SELECT *, least(most, max(share) OVER () * w) AS target FROM s2),
s4 AS (SELECT *, sum(target) OVER (ORDER BY no ROWS UNBOUNDED PRECEDING) / sum(target) OVER () AS part FROM s3),
s AS (SELECT *, lag(part, 1, 0.0) OVER (ORDER BY no) AS lo, CASE WHEN lead(part) OVER (ORDER BY no) IS NULL THEN 2.0 ELSE part END AS hi FROM s4),
k AS (SELECT greatest(1, least(4096, sum(size) // 65536))::BIGINT AS block, coalesce(sum(size), 0)::BIGINT AS words FROM d),
x AS (SELECT list_sum(list_transform(range(0, 40), lambda i: ((n >> i) & 1) / pow(2.0, i + 1))) AS p
      FROM (SELECT unnest(range(0, (words + block - 1) // block)) AS n FROM k)),
c AS (SELECT s.no, count(*) AS slots FROM x JOIN s ON x.p >= s.lo AND x.p < s.hi GROUP BY s.no),
m AS (SELECT s.*, least(coalesce(c.slots, 0) * k.block, 3 * s.source_size)::BIGINT AS reads FROM s LEFT JOIN c USING (no), k),
l AS (SELECT d.*, m.source_size, m.target, m.reads,
             sum(size) OVER (PARTITION BY m.no ORDER BY h, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) - size AS pos
      FROM d JOIN m ON d.source IS NOT DISTINCT FROM m.source)
SELECT doc_id, size, source_size, target,
       CASE WHEN size = 0 THEN 0 ELSE (reads // source_size) * size
         + greatest(0, least(size, reads % source_size - pos)) END::BIGINT AS taken
FROM l
""",
    # crc32 by its bits: every byte of the decimal id is xored in, then eight shifts
    "op11_prefix_trie": r"""
WITH RECURSIVE x AS (
  SELECT conv_id, turn, strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '') AS mark,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words
  FROM conversations WHERE conv_id IS NOT NULL),
t AS (SELECT conv_id, turn, words, sha256(mark)[1:32] AS mark FROM x),
own AS (SELECT conv_id, list({'m': mark, 'w': words} ORDER BY turn NULLS FIRST, mark) AS turns FROM t GROUP BY conv_id),
crc AS (
  SELECT conv_id, turns, xor(list_reduce(
    list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda d: [ord(d)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda c, b: xor(xor(c, b) >> 1, 3988292384::BIGINT * (xor(c, b) & 1))), 4294967295::BIGINT) % 4 AS h
  FROM own),
p AS (SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), c.turns[c.h + 1:]) AS turns
      FROM crc c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20),
m AS (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM p),
k AS (SELECT conv_id, depth, array_to_string(list_transform(turns[1:depth], lambda e: e.m), '/') AS path,
             CASE WHEN depth > 0 THEN array_to_string(list_transform(turns[1:depth - 1], lambda e: e.m), '/') END AS up,
             CASE WHEN depth > 0 THEN turns[depth].w ELSE 0 END AS words, len(turns) = depth AS ended FROM m),
n AS (SELECT path, any_value(depth) AS depth, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs,
             (count(*) - 1) * any_value(words) AS saved,
             sha256(coalesce(string_agg(CASE WHEN ended THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256
      FROM k GROUP BY path),
c AS (SELECT up, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY up),
s AS (SELECT n.path, n.up, n.depth, n.saved, CASE WHEN c.n_children IS NULL THEN 1 ELSE 0 END AS leaf FROM n LEFT JOIN c ON c.up = n.path),
r AS (SELECT path AS top, up, saved, leaf FROM s
      UNION ALL SELECT s.path, s.up, r.saved, r.leaf FROM r JOIN s ON s.path = r.up),
g AS (SELECT top, sum(saved) AS saved_tokens, sum(leaf) AS n_leaves FROM r GROUP BY top)
SELECT n.conv_id, n.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
       coalesce(c.n_children, 0)::BIGINT AS n_children, g.n_leaves::BIGINT AS n_leaves, g.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM n JOIN g ON g.top = n.path LEFT JOIN c ON c.up = n.path LEFT JOIN n u ON u.path = n.up
""",
    "op13_decontaminate": r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
i AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
v AS (SELECT item, least(10, len(w)) AS n, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS a FROM i WHERE len(w) > 0),
win AS (SELECT DISTINCT item, n, array_to_string(w[a:a + n - 1], ' ') AS gram FROM v),
sizes AS (SELECT DISTINCT n FROM win),
q AS (SELECT k, n, w, unnest(range(1, len(w) - n + 2)) AS a FROM d, sizes WHERE len(w) >= n),
hit AS (SELECT q.k, q.a, q.n, win.item FROM (SELECT k, n, a, array_to_string(w[a:a + n - 1], ' ') AS gram FROM q) q JOIN win ON win.n = q.n AND win.gram = q.gram),
words AS (SELECT k, count(DISTINCT place) AS n_hit FROM (SELECT k, unnest(range(a, a + n)) AS place FROM (SELECT DISTINCT k, a, n FROM hit)) GROUP BY k),
items AS (SELECT k, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT k, item FROM hit) GROUP BY k)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (k) LEFT JOIN items USING (k)
""",
}
