"""Streaming forms of the first two stages (S1, S2; S3 is in ``completion``).

The reference reacts to one event at a time; here each stage is a
Structured Streaming query over newly arrived files:

* S1 ``stream_chunks``: new content files -> B1 -> C1 -> C3 -> C4, appended
  to a parquet table (the file sink commits through its log). Content delivered
  again, under whatever file name, is chunked once.
* S2 ``stream_enrichment``: new result-line files -> ``foreachBatch`` running
  the batch job on the micro-batch and on the tables as all earlier epochs left
  them (``streaming.store``). Only changed rows are written; a replayed epoch
  reads and writes what it did before.

All queries take a checkpoint location; pass a folder in the cluster's
shared storage.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from docweave.functions.patterns import BATCH_SIZE
from docweave.plans.jobs import enrich_job, preprocess_job
from docweave.session import stage, temporary_tables
from docweave.sources import files
from docweave.streaming.store import EpochTables


def _trigger(writer, available_now: bool):
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")


def stream_chunks(spark: SparkSession, content_path: str, content_schema: StructType | str,
                  sink_path: str, checkpoint: str, available_now: bool = True,
                  max_files_per_trigger: int | None = None, columns: list[str] | None = None,
                  path_glob: str | None = None, redelivery: str | None = "30 days") -> StreamingQuery:
    """Chunk rows for every newly arrived content row.

    A row whose id and text arrived before, less than ``redelivery`` ago by the
    times of the files, is dropped; its id and a 128-bit hash are the state, which
    the watermark on file times bounds (None keeps no state and drops nothing).

    ``columns`` maps the files' columns to (id, content) as SQL expressions
    (default: they are already named so); ``path_glob`` limits which files
    of the folder are read."""
    reader = spark.readStream.schema(content_schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    content = reader.parquet(content_path)
    if columns:
        content = content.selectExpr(*columns, "_metadata")
    if redelivery:
        content = (content.select("id", "content", F.col("_metadata.file_modification_time").alias("_at"))
                   .withColumn("_text", F.concat_ws("-", F.xxhash64("content"), F.md5("content")))
                   .withWatermark("_at", redelivery).dropDuplicatesWithinWatermark(["id", "_text"]))
    chunks = preprocess_job(content)
    writer = (chunks.writeStream.format("parquet").option("path", sink_path)
              .option("checkpointLocation", checkpoint).outputMode("append"))
    return _trigger(writer, available_now).start()


#: the stored tables of the stream and their keys (None: only grows)
ENRICHMENT_TABLES = {"embeddings": "id", "content": "id", "batches": "id", "tags": None, "content_tags": None}


def _lines_stream(spark: SparkSession, path: str, max_files: int | None) -> DataFrame:
    reader = spark.readStream.format("text")
    return files.text_lines((reader.option("maxFilesPerTrigger", max_files) if max_files else reader).load(path))


def _epoch_writer(store: EpochTables, run: Callable[[DataFrame, dict[str, DataFrame]], dict[str, DataFrame]]):
    def epoch_done(batch: DataFrame, epoch: int) -> None:
        with temporary_tables(batch.sparkSession):      # this epoch's staged tables only
            state = {name: store.read(name, before=epoch) for name in store.keys}
            store.write(epoch, run(stage(files.with_line_order(batch)), state))
    return epoch_done


def stream_enrichment(spark: SparkSession, results_path: str, store: EpochTables,
                      source_batch_ids: Callable[[dict[str, DataFrame]], DataFrame], checkpoint: str,
                      as_of: datetime | str, available_now: bool = True, max_files_per_trigger: int | None = None,
                      batch_size: int = BATCH_SIZE) -> StreamingQuery:
    """New chat-result files -> A5 -> enrichment job per micro-batch.

    ``store`` holds ENRICHMENT_TABLES; each epoch runs on their state before it
    and adds its changes. The epoch's ``embedding_tags``, ``requests``,
    ``quarantine`` and ``bad_lines`` are written beside them.
    ``source_batch_ids`` names, from the tables' state, the batches whose
    results arrive."""
    def run(batch: DataFrame, t: dict[str, DataFrame]) -> dict[str, DataFrame]:
        good, bad = files.parse_enrichment_lines(batch)
        out = enrich_job(good, t["embeddings"], t["content"], t["tags"], t["content_tags"], t["batches"],
                         source_batch_ids(t), as_of, batch_size, changed_only=True)
        rows = dict(vars(out))
        rows["tags"] = rows.pop("new_tags")
        return rows | {"bad_lines": bad}

    writer = (_lines_stream(spark, results_path, max_files_per_trigger).writeStream
              .foreachBatch(_epoch_writer(store, run)).option("checkpointLocation", checkpoint))
    return _trigger(writer, available_now).start()
