"""Batch, embedding and content status."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.functions.patterns import (
    BATCH_TYPE,
    PROVIDER_COMPLETED,
    STATUS_COMPLETE,
    STATUS_EMBEDDING,
    STATUS_PENDING,
    STATUS_PROCESSED,
)
from docweave.operators.tables import allocate_ids, lookup, update_by_key


def _ids(df: DataFrame, col: str, alias: str = "id") -> DataFrame:
    return df.select(F.col(col).alias(alias)).distinct()


# --- B2 / B3 / B4 -------------------------------------------------------------------

def pending_batches(batches: DataFrame, embeddings_only: bool = False) -> DataFrame:
    """B2: batches not complete; stage 3 also requires type ``embeddings``."""
    cond = F.col("is_complete") == F.lit(False)
    if embeddings_only:
        cond = cond & (F.col("type") == BATCH_TYPE)
    return batches.where(cond)


def completed_at_provider(batches: DataFrame, provider_status: DataFrame) -> DataFrame:
    """Batches whose provider job reports ``completed``.
    ``provider_status``: (batch_id, status, output_file)."""
    done = provider_status.where(F.col("status") == PROVIDER_COMPLETED).drop("status")
    return batches.join(done, "batch_id")


def present_key(c: str | Column) -> Column:
    """A usable foreign key (Python truthiness: not null, not 0)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.isNotNull() & (c != 0)


# --- F1 ---------------------------------------------------------------------------------

def completed_contents(embeddings: DataFrame, embedding_ids: DataFrame,
                       strict: bool = False) -> DataFrame:
    """content ids none of whose checked embeddings has a status other
    than ``complete`` (null status does not count as incomplete).

    Default: only the given embeddings are checked. ``strict``: every
    embedding of a touched content is checked.
    """
    touched = lookup(embeddings.select("id", "content_id_id", "status"), embedding_ids)
    counted = embeddings.select("content_id_id", "status") if strict else touched
    # aggregate before any join on the content: a hot content is one row per task by then
    done = (counted.where(F.col("content_id_id").isNotNull())
            .groupBy("content_id_id")
            .agg(F.count_if(F.col("status") != STATUS_COMPLETE).alias("open"))
            .where(F.col("open") == 0))
    if strict:
        done = done.join(touched.select("content_id_id").distinct(), "content_id_id", "left_semi")
    return done.select(F.col("content_id_id").alias("id"))


# --- G1 - G8 -------------------------------------------------------------------------------

def create_batches(assigned: DataFrame, batches: DataFrame, external_ids: DataFrame | None = None,
                   as_of: datetime | str | None = None) -> DataFrame:
    """G1: one new batch row per batch number, type ``embeddings``, open.

    ``external_ids``: (batch_no, batch_id) from the provider; without it the
    external id is ``batch-<allocated id>``, so it never repeats between runs.
    """
    numbers = assigned.select("batch_no").distinct()
    if external_ids is not None:
        numbers = numbers.join(external_ids, "batch_no", "left")
    rows = numbers.withColumn("type", F.lit(BATCH_TYPE)).withColumn("is_complete", F.lit(False))
    created = allocate_ids(rows, batches, ["batch_no"])
    if external_ids is None:
        created = created.withColumn("batch_id", F.concat(F.lit("batch-"), F.col("id").cast("string")))
    if as_of is not None:
        ts = F.lit(as_of).cast("timestamp")
        created = created.withColumn("created_at", ts).withColumn("updated_at", ts)
    return created


def mark_batch_complete(batches: DataFrame, batch_ids: DataFrame,
                        as_of: datetime | str | None = None, changed_only: bool = False) -> DataFrame:
    """``is_complete = true`` for the given batch ids."""
    updates = _ids(batch_ids, batch_ids.columns[0]).withColumn("is_complete", F.lit(True))
    return update_by_key(batches, updates, as_of=as_of, unique=True, changed_only=changed_only)


def mark_in_batch(embeddings: DataFrame, assigned: DataFrame, new_batches: DataFrame,
                  as_of: datetime | str | None = None, changed_only: bool = False) -> DataFrame:
    """Each batched embedding gets its batch row id and status
    ``embedding content``. ``assigned``: (id, batch_no);
    ``new_batches``: (id, batch_no) from G1."""
    updates = (assigned.select("id", "batch_no")
               .join(new_batches.select(F.col("id").alias("batch_id_id"), "batch_no"), "batch_no")
               .select("id", "batch_id_id", F.lit(STATUS_EMBEDDING).alias("status")))
    return update_by_key(embeddings, updates, as_of=as_of, unique=True, changed_only=changed_only)


def apply_embeddings(embeddings: DataFrame, vectors: DataFrame, order_col: str = "line_order",
                     changed_only: bool = False) -> DataFrame:
    """Write vector, status and updated_at from parsed result lines
    (repeated ids: the last line wins).

    Vectors are long, so the last line of an id is found on (id, order) alone
    and its row is fetched by a semi join; the vectors are never sorted."""
    ordered = vectors.withColumn("_ord", F.struct(F.col(order_col).isNotNull(), F.col(order_col), F.xxhash64("embedding")))
    last = ordered.groupBy("id").agg(F.max("_ord").alias("_last")).withColumnRenamed("id", "_id")
    latest = (ordered.join(last, (F.col("id") == F.col("_id")) & F.col("_ord").eqNullSafe(F.col("_last")), "left_semi")
              .dropDuplicates(["id"]))     # only fully equal lines are left; the join's partitioning serves
    return update_by_key(embeddings, latest.drop(order_col, "_ord"), unique=True, changed_only=changed_only)


def mark_content_complete(content: DataFrame, content_ids: DataFrame,
                          as_of: datetime | str | None = None, changed_only: bool = False) -> DataFrame:
    """``is_complete = true`` for finished contents."""
    updates = _ids(content_ids, content_ids.columns[0]).withColumn("is_complete", F.lit(True))
    return update_by_key(content, updates, as_of=as_of, unique=True, changed_only=changed_only)


def attachments(embeddings: DataFrame, embedding_ids: DataFrame) -> DataFrame:
    """file/link/product/place keys of the given embeddings that are complete."""
    rows = lookup(embeddings, embedding_ids).where(F.col("status") == STATUS_COMPLETE)
    return rows.select(F.col("file_id_id").alias("file_id"), F.col("link_id_id").alias("link_id"),
                       F.col("product_id_id").alias("product_id"), F.col("place_id_id").alias("place_id"))


def processed_ids(attached: DataFrame, key: str) -> DataFrame:
    """G7 + B4: distinct usable ids of one attachment kind."""
    return attached.where(present_key(key)).select(F.col(key).alias("id")).distinct()


def mark_processed(target: DataFrame, attached: DataFrame, key: str,
                   as_of: datetime | str | None = None, changed_only: bool = False) -> DataFrame:
    """Status ``Processed`` on the links (key ``link_id``) or files
    (``file_id``) attached to completed embeddings."""
    updates = processed_ids(attached, key).withColumn("status", F.lit(STATUS_PROCESSED))
    return update_by_key(target, updates, as_of=as_of, unique=True, changed_only=changed_only)


def set_content_status(content: DataFrame, content_ids: DataFrame, status: str = STATUS_PENDING,
                       as_of: datetime | str | None = None, changed_only: bool = False) -> DataFrame:
    """Set a status on the given contents."""
    updates = _ids(content_ids, content_ids.columns[0]).withColumn("status", F.lit(status))
    return update_by_key(content, updates, as_of=as_of, unique=True, changed_only=changed_only)
