"""S3: new vectors complete embeddings and, when the last one is there, contents.

Two streaming queries with keyed state in the RocksDB store; nothing reads a
stored table again after the first micro-batch:

* ``stream_vectors``: result lines -> A6 -> one state per embedding id. The
  embedding table is the initial state (its keys and whether the row is open, no
  texts or vectors). Of several lines for an id in a micro-batch the last counts;
  every change carries a version, so a later one wins. Unknown ids change nothing.
  Changes and unusable lines go to one folder, partitioned by ``kind``.
* ``stream_contents``: the changes folder -> F1 by one state per content, which
  holds its number of open embeddings. A content is given out once, when that
  number is 0 (``strict``) or when its first vector arrives. Changes of a content
  are added up in each task before the shuffle, so a content with a third of all
  rows sends a row per task and batch.

Both write through the file sink's log: a replayed micro-batch is counted once,
as state and sink commit by the same batch number. ``completion_tables`` applies
the changes to the tables (G2, G4, G5, G7).

No ``from __future__ import annotations`` here: pandas UDFs read their types.
"""

from collections.abc import Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import LongType

from docweave.functions.patterns import STATUS_COMPLETE
from docweave.operators import lifecycle, tables
from docweave.plans.jobs import CompleteOutputs
from docweave.sources import files

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"

_KEYS = "content_id_id bigint, link_id_id bigint, file_id_id bigint, product_id_id bigint, place_id_id bigint"
ARRIVED = f"id bigint, {_KEYS}, version int, closed boolean, vector string"
_CHANGE = Row(*[c.split()[0] for c in ARRIVED.split(", ")])
CHANGES = (f"id bigint, {_KEYS}, version int, closed boolean, embedding array<float>, status string, updated_at timestamp, "
           "file_path string, line string, kind string")


class EmbeddingState(StatefulProcessor):
    """Per embedding: its foreign keys, whether it is open, its number of changes."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.row = handle.getValueState("row", f"{_KEYS}, open boolean, version int")

    def handleInitialState(self, key, row, timers) -> None:
        self.row.update((row.content_id_id, row.link_id_id, row.file_id_id, row.product_id_id, row.place_id_id, row.open, 0))

    def handleInputRows(self, key, rows, timers):
        state = self.row.get()
        if state is None:                 # an id the table does not have
            return
        *keys, was_open, version = state
        last = max(rows, key=lambda r: (r.file, r.block, r.place))
        self.row.update((*keys, False, version + 1))
        yield _CHANGE(key[0], *keys, version + 1, bool(was_open), last.vector)

    def close(self) -> None:
        pass


class ContentState(StatefulProcessor):
    """Per content: its number of open embeddings, and whether it was given out."""

    def __init__(self, strict: bool) -> None:
        self.strict = strict

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "open bigint, given boolean")

    def handleInitialState(self, key, row, timers) -> None:
        self.count.update((row.open, False))

    def handleInputRows(self, key, rows, timers):
        open_now, given = self.count.get() or (0, False)
        open_now -= sum(r.closed for r in rows)
        done = not given and (open_now <= 0 or not self.strict)
        self.count.update((open_now, given or done))
        if done:
            yield Row(id=key[0])

    def close(self) -> None:
        pass


@F.pandas_udf(LongType())
def _place(blocks: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """A number that grows along the rows of a task (a stream has no
    ``monotonically_increasing_id``); lines of a file block are in order in one task."""
    seen = 0
    for block in blocks:
        yield pd.Series(range(seen, seen + len(block)), dtype="int64")
        seen += len(block)


def _start(spark: SparkSession, rows: DataFrame, path: str, checkpoint: str, available_now: bool, by: str | None = None) -> StreamingQuery:
    writer = rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    writer = writer.partitionBy(by) if by else writer
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)       # a query keeps the settings it was started with
    try:
        return writer.start()
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def stream_vectors(spark: SparkSession, results_path: str, embeddings: DataFrame, root: str, checkpoint: str,
                   as_of: datetime | str, available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """New embedding-result files -> A6 -> changes under ``root``/changes. The
    table ``embeddings`` is read by the first micro-batch only."""
    reader = spark.readStream.format("text")
    text = (reader.option("maxFilesPerTrigger", max_files_per_trigger) if max_files_per_trigger else reader).load(results_path)
    lines = files.text_lines(text).withColumn("place", _place("file_block"))
    lines = lines.select("line", "file_path", F.struct(F.col("file_path").alias("file"), F.col("file_block").alias("block"), "place")
                         .alias("line_order")).where(F.col("line") != "")
    good, bad = files.parse_embedding_lines(lines, as_of)
    # a vector crosses to Python and back as one string
    arrived = good.select("id", F.to_json("embedding").alias("vector"), "line_order.*")
    is_open = F.coalesce(F.col("status") != STATUS_COMPLETE, F.lit(False)).alias("open")
    known = embeddings.select(F.col("id").cast("bigint").alias("id"), *[
        F.col(c.split()[0]).cast("bigint").alias(c.split()[0]) for c in _KEYS.split(", ")], is_open)
    changes = arrived.groupBy("id").transformWithState(EmbeddingState(), ARRIVED, "Append", "None", known.groupBy("id"))
    changes = changes.select(*[c for c in changes.columns if c != "vector"], F.from_json("vector", "array<float>").alias("embedding"),
                             F.lit(STATUS_COMPLETE).alias("status"), F.lit(as_of).cast("timestamp").alias("updated_at"),
                             F.lit("embeddings").alias("kind"))
    rows = changes.unionByName(bad.withColumn("kind", F.lit("bad_lines")), allowMissingColumns=True)
    return _start(spark, rows, f"{root}/changes", f"{checkpoint}/changes", available_now, "kind")


def _added_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        yield rows.groupby("content_id_id", as_index=False)["closed"].sum()


def stream_contents(spark: SparkSession, embeddings: DataFrame, root: str, checkpoint: str, strict: bool = True,
                    available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Changes -> F1 -> (id) of finished contents under ``root``/contents, each once."""
    reader = spark.readStream.schema(CHANGES)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    touched = (reader.parquet(f"{root}/changes").where("kind = 'embeddings' and content_id_id is not null")
               .select("content_id_id", F.col("closed").cast("bigint").alias("closed"))
               .mapInPandas(_added_up, "content_id_id bigint, closed bigint"))
    content = F.col("content_id_id").cast("bigint").alias("content_id_id")
    known = (embeddings.where("content_id_id is not null").groupBy(content)
             .agg(F.count_if(F.col("status") != STATUS_COMPLETE).alias("open")))
    done = touched.groupBy("content_id_id").transformWithState(ContentState(strict), "id bigint", "Append", "None",
                                                               known.groupBy("content_id_id"))
    return _start(spark, done, f"{root}/contents", f"{checkpoint}/contents", available_now)


def stream_completion(spark: SparkSession, results_path: str, embeddings: DataFrame, root: str, checkpoint: str,
                      as_of: datetime | str, strict: bool = True, available_now: bool = True,
                      max_files_per_trigger: int | None = None) -> list[StreamingQuery]:
    """S3: both queries. With ``available_now`` the second starts when the first
    has read all there is; otherwise both run until they are stopped."""
    vectors = stream_vectors(spark, results_path, embeddings, root, checkpoint, as_of, available_now, max_files_per_trigger)
    if available_now:
        vectors.awaitTermination()
    return [vectors, stream_contents(spark, embeddings, root, checkpoint, strict, available_now)]


def changes(spark: SparkSession, root: str) -> DataFrame:
    """All changes of embeddings so far, every version."""
    return spark.read.schema(CHANGES).parquet(f"{root}/changes").where("kind = 'embeddings'")


def bad_lines(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(CHANGES).parquet(f"{root}/changes").where("kind = 'bad_lines'").select("file_path", "line")


def completion_tables(spark: SparkSession, root: str, embeddings: DataFrame, batches: DataFrame, batch_ids: DataFrame,
                      content: DataFrame, links: DataFrame, file_table: DataFrame) -> CompleteOutputs:
    """The tables with all changes so far applied."""
    seen = changes(spark, root)
    # vectors are long: the last version of an id is found on two numbers, its row by a semi join
    last = seen.groupBy("id").agg(F.max("version").alias("version"))
    updates = seen.join(last, ["id", "version"], "left_semi").select("id", "embedding", "status", "updated_at")
    attached = seen.select(*[F.col(f"{k}_id_id").alias(f"{k}_id") for k in ("file", "link", "product", "place")])
    done = spark.read.schema("id bigint").parquet(f"{root}/contents")
    return CompleteOutputs(
        embeddings=tables.update_by_key(embeddings, updates, unique=True),
        batches=lifecycle.mark_batch_complete(batches, batch_ids),
        content=lifecycle.mark_content_complete(content, done),
        links=lifecycle.mark_processed(links, attached, "link_id"),
        files=lifecycle.mark_processed(file_table, attached, "file_id"))
