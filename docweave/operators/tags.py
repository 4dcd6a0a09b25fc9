"""Keyword tags with get-or-create semantics."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.functions import metadata as md
from docweave.functions.text import slug_key, title_name, type_key
from docweave.operators.skew import join_unique
from docweave.operators.tables import allocate_ids
from docweave.session import stage


def with_keywords(df: DataFrame, metadata_col: str = "metadata", out: str = "_keywords") -> DataFrame:
    """Add the ``keywords`` list of the metadata JSON (empty when absent).

    The JSON is parsed once into a column of its own; the list is built from
    that column in a second projection, so the text is not parsed again for
    every field the list cleaning reads."""
    parsed = df.withColumn("_kw_entry", md.entry(md.json_entries(F.col(metadata_col)), "keywords"))
    e = F.col("_kw_entry")
    keywords = F.coalesce(F.when(e.isNotNull(), md.clean_meta_list(e)), F.array().cast("array<string>"))
    return parsed.withColumn(out, keywords).drop("_kw_entry")


def explode_keywords(enriched: DataFrame, id_col: str = "id",
                     out_id: str = "embedding_id") -> DataFrame:
    """One (embedding_id, keyword) row per keyword; none when missing.

    ``explode_outer`` + a null filter instead of ``explode``: for ``explode``
    Spark infers a ``size(list) > 0`` filter and pushes it below, where it
    would parse every JSON text a second time."""
    rows = with_keywords(enriched.select(F.col(id_col).alias(out_id), "metadata"))
    return rows.select(out_id, F.explode_outer("_keywords").alias("keyword")).where(F.col("keyword").isNotNull())


def _get_or_create(keys: DataFrame, dim: DataFrame, as_of: datetime | str | None) -> tuple[DataFrame, DataFrame]:
    """Shared E3/E4 step. ``keys``: (key, name) candidates, one per key.
    Returns (new dimension rows, key -> id for every requested key)."""
    # The distinct keys are read by the id allocation and the final mapping:
    # written once (as many rows as the vocabulary has words).
    keys = stage(keys)
    existing = dim.select("id", "key")
    new = keys.join(existing.select("key"), "key", "left_anti")
    created = allocate_ids(new, dim, ["key"])
    if as_of is not None:
        ts = F.lit(as_of).cast("timestamp")
        created = created.withColumn("created_at", ts).withColumn("updated_at", ts)
    # A key stored twice resolves to its smallest id.
    known = existing.groupBy("key").agg(F.min("id").alias("id"))
    ids = (keys.select("key").join(known.unionByName(created.select("key", "id")), "key")
           .select("key", F.col("id").alias("tag_id")))
    return created, ids


def tags_get_or_create(keywords: DataFrame, tags: DataFrame,
                       as_of: datetime | str | None = None) -> tuple[DataFrame, DataFrame]:
    """Slug every keyword, create the missing tags (new ids in key order,
    name from the key), and map every slug to its tag id.
    Returns (new tag rows, (key, tag_id))."""
    keys = (keywords.select(slug_key("keyword").alias("key")).where(F.col("key").isNotNull())
            .distinct().withColumn("name", title_name("key")))
    return _get_or_create(keys, tags, as_of)


def types_get_or_create(names: DataFrame, types: DataFrame,
                        as_of: datetime | str | None = None) -> tuple[DataFrame, DataFrame]:
    """Same for the type dimension: key = lower-case words joined by
    ``_``, name kept as given (the first name seen for a key, by name order)."""
    keys = (names.select(type_key("name").alias("key"), "name").where(F.col("key").isNotNull())
            .groupBy("key").agg(F.min("name").alias("name")))
    return _get_or_create(keys, types, as_of)


def embedding_tag_pairs(exploded: DataFrame, tag_ids: DataFrame) -> DataFrame:
    """E5: (embedding_id, tag_id) for every exploded keyword (not deduplicated).

    ``tag_ids`` has one row per distinct keyword. Rows of a keyword that holds
    much of the table are dealt over many tasks (``skew.join_unique``, which
    counts keywords first: stage ``exploded`` when it still parses JSON).
    """
    keyed = exploded.select("embedding_id", slug_key("keyword").alias("key"))
    return join_unique(keyed, tag_ids, "key", spread=["embedding_id"]).select("embedding_id", "tag_id")


def new_content_tag_pairs(merged: DataFrame, tag_ids: DataFrame,
                          stored_pairs: DataFrame) -> DataFrame:
    """Distinct (content_id, tag_id) from the merged content keywords,
    minus the pairs already stored.

    The keywords are parsed once and staged: the count of heavy keywords and
    the join read the staged rows."""
    rows = (with_keywords(merged.select(F.col("id").alias("content_id"), "metadata"))
            .select("content_id", F.explode_outer("_keywords").alias("keyword")).where(F.col("keyword").isNotNull()))
    keyed = stage(rows.select("content_id", slug_key("keyword").alias("key")))
    pairs = join_unique(keyed, tag_ids, "key", spread=["content_id"]).select("content_id", "tag_id").distinct()
    return pairs.join(stored_pairs.select("content_id", "tag_id"), ["content_id", "tag_id"], "left_anti")
