"""The three pipeline stages as whole-table jobs.

Each job takes DataFrames and returns the new table versions as
DataFrames; ``write_outputs`` materializes them. Frames that several outputs
read are written once (``session.stage``) so they are not recomputed, and so a
lost executor recomputes from the written copy, not from the source. Run a job
and its writes in one ``session.temporary_tables`` block to drop them after.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.functions.patterns import BATCH_SIZE, STATUS_EMBEDDING
from docweave.functions.text import normalize_text
from docweave.operators import chunking, enrichment, lifecycle, tables, tags
from docweave.session import stage
from docweave.sources import files


def nonempty_content(content: DataFrame, col: str = "content") -> DataFrame:
    """B1: content that is neither null nor empty."""
    return content.where(F.col(col).isNotNull() & (F.col(col) != ""))


# --- stage 1 ----------------------------------------------------------------------------

def preprocess_job(content: DataFrame, splitter: str = "recursive") -> DataFrame:
    """Content -> B1 -> C1 -> C3 -> C4: chunk rows for every non-empty content.
    ``splitter``: recursive, native (the same rows without Python) or window."""
    clean = nonempty_content(content).select(
        F.col("id").alias("content_id"), normalize_text("content").alias("text"))
    split = {"recursive": chunking.chunk_recursive, "native": chunking.chunk_recursive_native, "window": chunking.chunk_window}
    return chunking.chunk_records(split[splitter](clean, "text", ["content_id"]))


# --- stage 2 ----------------------------------------------------------------------------

@dataclass
class EnrichOutputs:
    embeddings: DataFrame        # new version of the embedding table
    new_tags: DataFrame          # rows to append to the tag table
    embedding_tags: DataFrame    # (embedding_id, tag_id) to append
    content: DataFrame           # new version of the content table (metadata)
    content_tags: DataFrame      # (content_id, tag_id) to append
    batches: DataFrame           # new version of the batch table
    requests: DataFrame          # (batch_no, id, line) request lines
    quarantine: DataFrame        # result lines that were unusable


def enrich_job(responses: DataFrame, embeddings: DataFrame, content: DataFrame, tag_table: DataFrame,
               content_tag_table: DataFrame, batches: DataFrame, source_batch_ids: DataFrame,
               as_of: datetime | str, batch_size: int = BATCH_SIZE, changed_only: bool = False) -> EnrichOutputs:
    """A5 output -> D4 -> {A9 + G3, E2->E3->E5, D5->D6, E6, E1->A7/G1}.

    ``responses``: (embedding_id, response, line_order); of several lines for
    one embedding the last counts, everywhere in the job. The source batch is
    marked complete once; new batches stay open. With ``changed_only`` the
    embedding, content and batch outputs hold only changed and new rows.

    Intermediates that several outputs read are staged; write the outputs
    inside the same ``session.temporary_tables`` block, if any.
    """
    latest = tables.last_update_per_key(responses, "embedding_id", "line_order")
    enriched, unmatched = enrichment.enrich_embeddings(latest, embeddings, as_of)
    enriched = stage(enriched)

    exploded = stage(tags.explode_keywords(enriched))      # parsed once, read by tags and pairs
    new_tags, tag_ids = tags.tags_get_or_create(exploded, tag_table, as_of)
    emb_tags = tags.embedding_tag_pairs(exploded, tag_ids)

    merged = enrichment.merge_metadata_by_content(
        enriched.select(F.col("content_id_id").alias("content_id"), "id", "metadata"))
    merged = stage(merged)      # one row per content, read by two outputs
    overlay = enrichment.overlay_content_metadata(content, merged)
    content_new = tables.update_by_key(content, overlay, as_of=as_of, unique=True, changed_only=changed_only)
    content_tags = tags.new_content_tag_pairs(merged, tag_ids, content_tag_table)

    # (id, batch_no) is read by batch creation, status updates and request
    # lines; it is small (two numbers per row), so write it once.
    assigned = tables.assign_batches(enriched.select("id"), ["id"], batch_size)
    assigned = stage(assigned)
    created = lifecycle.create_batches(assigned, batches, as_of=as_of)
    created = stage(created)    # ids allocated once, read by two outputs
    batches_new = lifecycle.mark_batch_complete(batches, source_batch_ids, changed_only=changed_only).unionByName(
        created.select(*batches.columns))
    # One keyed update of the embedding table carries both the enriched fields
    # (A9) and the batch id and status (G3): one join over the largest table.
    batch_of = assigned.join(created.select(F.col("id").alias("batch_id_id"), "batch_no"), "batch_no")
    updates = (enriched.select("id", "context", "metadata", "updated_at")
               .join(batch_of.select("id", "batch_id_id"), "id")
               .withColumn("status", F.lit(STATUS_EMBEDDING)))
    embeddings_new = tables.update_by_key(embeddings, updates, unique=True, changed_only=changed_only)
    requests = files.embedding_requests(assigned.join(enriched.select("id", "context"), "id"))
    quarantine = unmatched.select(F.lit("unmatched").alias("reason"),
                                  F.col("embedding_id").cast("string").alias("detail"))
    return EnrichOutputs(embeddings_new, new_tags, emb_tags, content_new, content_tags,
                         batches_new, requests, quarantine)


# --- stage 3 ----------------------------------------------------------------------------

@dataclass
class CompleteOutputs:
    embeddings: DataFrame
    batches: DataFrame
    content: DataFrame
    links: DataFrame
    files: DataFrame


def complete_job(vectors: DataFrame, embeddings: DataFrame, batches: DataFrame, batch_ids: DataFrame,
                 content: DataFrame, links: DataFrame, file_table: DataFrame,
                 as_of: datetime | str, strict: bool = False, changed_only: bool = False) -> CompleteOutputs:
    """A6 output -> G4 -> {G2, F1 -> G5, G6 -> G7}.

    ``vectors``: (id, embedding, status, updated_at, line_order); the last line
    of an id counts. The updated rows are read by three outputs, so they are
    staged. With ``changed_only`` every output holds only changed rows."""
    changed = stage(lifecycle.apply_embeddings(embeddings, vectors, changed_only=True))
    ids = changed.select("id")
    others = embeddings.join(ids, "id", "left_anti")
    # default F1 and G6 look at the updated rows only; strict F1 at all rows of their contents
    done = lifecycle.completed_contents(others.unionByName(changed) if strict else changed, ids, strict=strict)
    attached = lifecycle.attachments(changed, ids)
    keep = {"changed_only": changed_only}
    return CompleteOutputs(
        embeddings=changed if changed_only else others.unionByName(changed),
        batches=lifecycle.mark_batch_complete(batches, batch_ids, **keep),
        content=lifecycle.mark_content_complete(content, done, **keep),
        links=lifecycle.mark_processed(links, attached, "link_id", **keep),
        files=lifecycle.mark_processed(file_table, attached, "file_id", **keep))


def write_outputs(outputs, root: str) -> None:
    """Write each output frame as a parquet table version under ``root``."""
    for name, df in vars(outputs).items():
        df.write.mode("overwrite").parquet(f"{root}/{name}")


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}")
