"""Merging model output into embedding rows and content metadata.

Metadata travels as JSON text. Per-key work uses the typed entries of
``docweave.functions.metadata`` and plain aggregates, so nothing gathers a
whole content's rows in one place except the content's own output value.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.functions import metadata as md
from docweave.session import stage

#: tasks over which the rows of one (content, key) are spread
_SALT = 32


# --- D4 -----------------------------------------------------------------------------

def _python_text(c: Column) -> Column:
    return F.coalesce(c, F.lit("None"))


def enriched_context(context: Column, metadata: Column, m: Column, r: Column) -> Column:
    """D4 context from the stored context, metadata and model response
    (``m``, ``r``: their parsed entries)."""
    question = F.when(md.has_key(m, "question"),
                      F.concat(F.lit("Question: "), md.render(md.entry(m, "question")), F.lit("\n"))
                      ).otherwise("")
    head = F.when(metadata.isNotNull(), F.concat(
        question, _python_text(context), F.lit("\n\n"),
        F.lit("Metadata:\n"), md.metadata_text_v2(entries=m), F.lit("\n\n"))
    ).otherwise(F.concat(_python_text(context), F.lit("\n\n")))
    content = F.when(md.has_key(r, "content"), F.concat(
        F.lit("Rephrased Content: "), md.render(md.entry(r, "content")), F.lit("\n"))).otherwise("")
    questions = F.when(md.has_key(r, "questions"), F.concat(
        F.lit("Additional Sample Questions: "), md.joined_value(md.entry(r, "questions")), F.lit("\n"))
    ).otherwise("")
    keywords = F.when(md.has_key(r, "keywords"), F.concat(
        F.lit("Keywords: "), md.joined_value(md.entry(r, "keywords")))).otherwise("")
    return F.concat(head, content, questions, keywords)


def enriched_metadata(m: Column, r: Column) -> Column:
    """D4 metadata: stored keys, then ``questions`` and ``keywords`` (D3
    cleaned) set in place or appended, as JSON text (``m``, ``r``: parsed
    entries of the stored metadata and of the response)."""
    new = {}
    for key in ("questions", "keywords"):
        new[key] = F.when(md.has_key(r, key), F.to_json(md.clean_meta_list(md.entry(r, key))))

    def replaced(e):
        value = md.value_json(e)
        for key, js in new.items():
            value = F.when((e.key == key) & js.isNotNull(), js).otherwise(value)
        return F.struct(e.key.alias("key"), value.alias("json"))

    entries = F.transform(m, replaced)
    for key, js in new.items():
        extra = F.when(js.isNotNull() & ~md.has_key(m, key),
                       F.array(F.struct(F.lit(key).alias("key"), js.alias("json"))))
        entries = F.concat(entries, F.coalesce(extra, F.array().cast("array<struct<key:string,json:string>>")))
    return md.entries_to_json(entries)


def enrich_embeddings(responses: DataFrame, embeddings: DataFrame,
                      as_of: datetime | str) -> tuple[DataFrame, DataFrame]:
    """Join each model response to its embedding row and rebuild the
    context and metadata. Returns (enriched, unmatched responses).

    ``responses``: (embedding_id, response) with the response's JSON text.
    ``embeddings``: (id, content_id_id, context, metadata).
    """
    emb = embeddings.select("id", "content_id_id", "context", "metadata")
    joined = responses.join(emb, responses["embedding_id"] == emb["id"], "inner")
    # parse each JSON text once; the expressions below reuse the parsed entries
    parsed = joined.select("id", "content_id_id", "context", "metadata",
                           md.json_entries("metadata").alias("_m"), md.json_entries("response").alias("_r"))
    m, r = F.col("_m"), F.col("_r")
    enriched = parsed.select(
        F.col("id"), F.col("content_id_id"),
        enriched_context(F.col("context"), F.col("metadata"), m, r).alias("context"),
        enriched_metadata(m, r).alias("metadata"),
        F.lit(as_of).cast("timestamp").alias("updated_at"))
    unmatched = responses.join(emb.select(F.col("id").alias("embedding_id")), "embedding_id", "left_anti")
    return enriched, unmatched


# --- D5 -----------------------------------------------------------------------------------

def _element_jsons(raw: Column) -> Column:
    return F.transform(F.from_json(raw, "array<variant>"), lambda x: F.to_json(x))


def _summaries_of_rows(rows: DataFrame, content_col: str, order_col: str, metadata_col: str) -> DataFrame:
    """Every (row, key) as the summary of a segment of one value."""
    entries = rows.select(
        F.col(content_col).alias("cid"), F.col(order_col).alias("last_ord"),
        F.posexplode_outer(md.json_entries(F.col(metadata_col))).alias("pos", "e")).where(F.col("pos").isNotNull())
    return entries.select("cid", F.col("e.key").alias("key"), F.struct(F.col("last_ord").alias("ord"), "pos").alias("first"), "last_ord",
                          F.col("e.type").alias("run_type"), F.lit(True).alias("uniform"),
                          F.lit(1).cast("bigint").alias("members"), md.value_json(F.col("e")).alias("json"))


def _fold(parts: DataFrame) -> DataFrame:
    """One summary per (cid, key) of the summaries of ordered segments."""
    # Several steps below read the parsed entries: written once.
    parts = stage(parts)

    # Where the last run of one type starts: types seen per key are few (<= 7).
    # It starts after the last value of another type, or in the last segment
    # that holds several types. The same two aggregations also give each key's
    # first appearance (its place in the output object).
    per_type = parts.groupBy("cid", "key", "run_type").agg(
        F.max("last_ord").alias("last_ord"), F.min("first").alias("first"),
        F.max(F.when(~F.col("uniform"), F.col("last_ord"))).alias("mixed_ord"))
    runs = per_type.groupBy("cid", "key").agg(
        F.max_by("run_type", "last_ord").alias("run_type"),
        F.sort_array(F.collect_list(F.struct("last_ord", "run_type")), asc=False).alias("seen"),
        F.min("first").alias("first"), F.max("mixed_ord").alias("mixed_ord"))
    runs = runs.select("cid", "key", F.col("run_type").alias("type"), "first", "mixed_ord", F.get(
        F.filter("seen", lambda s: s.run_type != F.col("run_type")), 0).last_ord.alias("break_ord"))
    whole = runs.select("cid", "key", "first",
                        (F.col("break_ord").isNull() & F.col("mixed_ord").isNull()).alias("uniform"))

    # The join is salted: a content that holds a large part of all rows is spread
    # over _SALT tasks here, and the aggregations below combine its rows before
    # they shuffle them.
    salted = (runs.drop("first").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(_SALT - 1)))))
    run = (parts.drop("first", "uniform", "run_type")
           .withColumn("_salt", F.expr(f"cast(pmod(xxhash64(last_ord), {_SALT}) as int)"))
           .join(salted, ["cid", "key", "_salt"]).drop("_salt")
           .where(F.col("break_ord").isNull() | (F.col("last_ord") > F.col("break_ord")))
           .where(F.col("mixed_ord").isNull() | (F.col("last_ord") >= F.col("mixed_ord"))))

    scalar = run.groupBy("cid", "key").agg(
        F.max_by("json", "last_ord").alias("last_json"), F.sum("members").alias("members"),
        F.max("last_ord").alias("last_ord"), F.first("type").alias("run_type"))

    list_items = (run.where(F.col("type") == "list")
                  .select("cid", "key", F.explode_outer(_element_jsons(F.col("json"))).alias("item"))
                  .where(F.col("item").isNotNull())
                  .distinct()
                  .groupBy("cid", "key")
                  .agg(F.concat(F.lit("["), F.array_join(F.sort_array(F.collect_list("item")), ","),
                                F.lit("]")).alias("union_json")))

    dict_pairs = (run.where(F.col("type") == "dict")
                  .select("cid", "key", "last_ord", F.posexplode_outer(md.json_entries(F.col("json"))).alias("p2", "e2"))
                  .where(F.col("p2").isNotNull())
                  .groupBy("cid", "key", F.col("e2.key").alias("k2"))
                  .agg(F.max_by(md.value_json(F.col("e2")), "last_ord").alias("j2"),
                       F.min(F.struct("last_ord", "p2")).alias("f2")))
    dict_json = (dict_pairs.groupBy("cid", "key")
                 .agg(F.sort_array(F.collect_list(F.struct("f2", F.col("k2").alias("key"),
                                                           F.col("j2").alias("json")))).alias("pairs"))
                 .select("cid", "key", md.entries_to_json(
                     F.transform("pairs", lambda p: F.struct(p.key.alias("key"), p.json.alias("json"))))
                         .alias("dict_json")))

    return (scalar.join(list_items, ["cid", "key"], "left")
            .join(dict_json, ["cid", "key"], "left")
            .join(whole, ["cid", "key"])
            .select("cid", "key", "first", "last_ord", "run_type", "uniform", "members", F.when(
                (F.col("run_type") == "list") & (F.col("members") > 1), F.col("union_json"))
                .when(F.col("run_type") == "dict", F.col("dict_json"))
                .otherwise(F.col("last_json")).alias("json")))


def summarize_metadata(rows: DataFrame, content_col: str = "content_id", order_col: str = "id",
                       metadata_col: str = "metadata") -> DataFrame:
    """What D5 needs to know of each content's rows, one row per (content, key):

    (cid, key, first, last_ord, run_type, uniform, members, json) - where the key
    first appeared, where it appeared last, the type and number of the values in
    its last run, whether that run is all there is, and the run's merged value.
    ``order_col`` is unique within a content."""
    return _fold(_summaries_of_rows(rows, content_col, order_col, metadata_col))


def combine_summaries(older: DataFrame, newer: DataFrame) -> DataFrame:
    """The summary of two ordered segments from theirs: within a content, all rows
    of ``newer`` come after those of ``older``. Associative, so segments may be
    combined in any grouping."""
    return _fold(older.unionByName(newer))


def extend_summaries(stored: DataFrame, rows: DataFrame, history: DataFrame, content_col: str = "content_id",
                     order_col: str = "id", metadata_col: str = "metadata") -> DataFrame:
    """Summaries of the contents in ``rows``, after these rows joined those
    summarized in ``stored``; other contents are not read.

    A content with a row that is not after all its stored ones cannot be
    extended: it is summarized again from ``history``, which holds all rows, the
    new ones included (rows that replace a stored one are such rows)."""
    names = (content_col, order_col, metadata_col)
    rows = stage(rows.select(*names))
    begins = rows.groupBy(F.col(content_col).alias("cid")).agg(F.min(order_col).alias("_from"))
    known = stored.join(begins, "cid", "left_semi")
    ends = known.groupBy("cid").agg(F.max("last_ord").alias("_to"))
    late = stage(begins.join(ends, "cid").where(F.col("_from") <= F.col("_to")).select("cid"))

    def of_late(df, column, how):
        return df.join(late.select(F.col("cid").alias(column)), column, how)

    again = of_late(history.select(*names), content_col, "left_semi")
    in_time = of_late(rows, content_col, "left_anti")
    return _fold(of_late(known, "cid", "left_anti").unionByName(_summaries_of_rows(in_time.unionByName(again), *names)))


def summarized_metadata(summaries: DataFrame) -> DataFrame:
    """(id, metadata): the merged metadata that summaries stand for, as JSON text."""
    return (summaries.groupBy("cid")
            .agg(F.sort_array(F.collect_list(F.struct("first", "key", "json"))).alias("kv"))
            .select(F.col("cid").alias("id"), md.entries_to_json(
                F.transform("kv", lambda p: F.struct(p.key.alias("key"), p.json.alias("json"))))
                    .alias("metadata")))


def merge_metadata_by_content(rows: DataFrame, content_col: str = "content_id",
                              order_col: str = "id", metadata_col: str = "metadata") -> DataFrame:
    """Fold the metadata of each content's rows, in ``order_col`` order.

    Per key only the last run of same-typed values matters: lists are
    unioned when the run has two or more (sorted, duplicates removed) and
    kept as they are otherwise; dicts are shallow-updated in order; other
    values (null too) take the last. Keys keep first-seen order.
    Output: (id, metadata) with metadata as JSON text.
    """
    return summarized_metadata(summarize_metadata(rows, content_col, order_col, metadata_col))


# --- D6 -----------------------------------------------------------------------------------------

def overlay_json(current: Column, new: Column) -> Column:
    """``{**current, **new}`` on JSON texts: current keys keep their place
    (value from ``new`` when it has the key, null included), new keys follow."""
    def json_by_key(text):
        return F.map_from_entries(F.transform(md.json_entries(text), lambda e: F.struct(e.key, md.value_json(e))))

    # the zip lists the first map's keys in order, then the second's new ones; a
    # JSON null is the text 'null' here, so a missing key is the only null
    both = F.map_zip_with(json_by_key(current), json_by_key(new), lambda k, cur, nxt: F.coalesce(nxt, cur))
    return md.entries_to_json(F.transform(F.map_entries(both), lambda e: F.struct(e.key.alias("key"), e.value.alias("json"))))


def overlay_content_metadata(content: DataFrame, merged: DataFrame) -> DataFrame:
    """(id, metadata) updates: the content's stored metadata overlaid with
    the merged one; a null or missing stored value counts as empty."""
    cur = content.select("id", F.col("metadata").alias("_cur"))
    return (merged.join(cur, "id", "left")
            .select("id", overlay_json(F.col("_cur"), F.col("metadata")).alias("metadata")))
