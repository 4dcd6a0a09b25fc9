"""File sources and sinks: tabular input (A4), model result lines (A5, A6,
A6b) and embedding request lines (A7).

Result files are read as text lines and parsed with an explicit schema, so
a malformed or errored line becomes a quarantine row instead of failing
the file.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.functions.patterns import (
    BATCH_SIZE,
    DROPPED_COLUMN,
    NA_CELLS,
    REQUEST_ID_PREFIX,
    REQUEST_METHOD,
    REQUEST_MODEL,
    REQUEST_URL,
    STATUS_COMPLETE,
)
from docweave.sources import records

ENRICHMENT_LINE = (
    "custom_id string, response struct<status_code:int, body:struct<choices:"
    "array<struct<message:struct<content:string>>>>>, error string"
)
# The vector is read as text so that both a JSON list and a JSON string
# holding a list parse (from_json below).
EMBEDDING_LINE = (
    "custom_id string, response struct<status_code:int, body:struct<data:"
    "array<struct<embedding:string>>>>, error string"
)


# --- A4 ---------------------------------------------------------------------------------

def read_tabular(spark: SparkSession, path: str, fmt: str, multi_line: bool = True, split: bool = True) -> DataFrame:
    """A4: csv (header) or json (records) files of any size; the pandas index
    column is dropped, and nulls and the cells pandas reads as missing become ''.
    Every column is text, as filling nulls with '' makes mixed columns.

    ``multi_line`` (default): quoted cells may hold line breaks and a json file
    may be one array; a file is still read by many tasks (``sources.records``),
    unless ``split`` is off, for csv files with stray quotes. Without
    ``multi_line`` every record must be on one line."""
    if fmt == "csv" and multi_line and split:
        df = records.read_csv(spark, path)
    elif fmt == "csv":
        df = (spark.read.option("header", True).option("multiLine", multi_line)
              .option("quote", '"').option("escape", '"').csv(path))
    elif fmt == "json" and multi_line and split:
        df = records.read_json(spark, path)
    elif fmt == "json":
        df = spark.read.option("multiLine", multi_line).json(path)
    else:
        raise ValueError(f"unsupported tabular format: {fmt}")
    # pandas names an empty first header "Unnamed: 0"; Spark's CSV reader names it "_c0"
    if DROPPED_COLUMN in df.columns:
        df = df.drop(DROPPED_COLUMN)
    elif fmt == "csv" and df.columns and df.columns[0] == "_c0":
        df = df.drop("_c0")

    def cell(name):
        text = F.col(f"`{name}`").cast("string")
        known = F.when(~text.isin(NA_CELLS), text) if fmt == "csv" else text
        return F.coalesce(known, F.lit("")).alias(name)

    return df.select(*[cell(c) for c in df.columns])


# --- shared line reading -------------------------------------------------------------------

def text_lines(text: DataFrame) -> DataFrame:
    """(line, file_path, file_block) of a text source, batch or stream."""
    return text.select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file_path"),
                       F.col("_metadata.file_block_start").alias("file_block"))


def with_line_order(lines: DataFrame) -> DataFrame:
    """(line, file_path, line_order) without empty lines. ``line_order`` orders
    lines by file name, then by their place in the file: the start of the file
    block and a counter that grows inside it. For batch frames (in a stream:
    inside the micro-batch)."""
    order = F.struct(F.col("file_path").alias("file"), F.col("file_block").alias("block"), F.monotonically_increasing_id().alias("line"))
    return lines.select("line", "file_path", order.alias("line_order")).where(F.col("line") != "")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return with_line_order(text_lines(spark.read.text(path)))


def request_id(custom_id: Column, piece: int = -1) -> Column:
    """Numeric id inside ``request-<id>``: the last ``-`` piece by default,
    the second (index 1) for the table variant; anything else than a number that
    fits a BIGINT gives null."""
    text = F.substring_index(custom_id, "-", -1) if piece == -1 else F.get(F.split(custom_id, "-"), piece)
    return F.when(text.rlike(r"^[0-9]+$"), text.try_cast("bigint"))


def _split_good_bad(parsed: DataFrame, ok: Column, good_cols: list[Column]) -> tuple[DataFrame, DataFrame]:
    good = parsed.where(ok).select(*good_cols)
    bad = parsed.where(~ok | ok.isNull()).select("file_path", "line")
    return good, bad


# --- A5 -------------------------------------------------------------------------------------

def parse_enrichment_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A5 on a (line, file_path, line_order) frame: (embedding_id, response,
    line_order) where ``response`` is the JSON text in the first choice's
    message, plus the lines that could not be used."""
    p = lines.select("file_path", "line", "line_order", F.from_json("line", ENRICHMENT_LINE).alias("j"))
    content = F.get(p["j.response.body.choices"], 0)["message"]["content"]
    p = p.select("file_path", "line", "line_order", request_id(F.col("j.custom_id")).alias("embedding_id"),
                 content.alias("response"))
    ok = (F.col("embedding_id").isNotNull() & F.col("response").isNotNull()
          & F.from_json("response", "map<string,string>").isNotNull())
    return _split_good_bad(p, ok, [F.col("embedding_id"), F.col("response"), F.col("line_order")])


def read_enrichment_output(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """A5: chat result JSONL files; empty lines skipped."""
    return parse_enrichment_lines(_lines(spark, path))


# --- A6 / A6b ---------------------------------------------------------------------------------------

def _vector(p: DataFrame) -> Column:
    return F.from_json(F.get(p["j.response.body.data"], 0)["embedding"], "array<float>")


def parse_embedding_lines(lines: DataFrame, as_of: datetime | str) -> tuple[DataFrame, DataFrame]:
    """(id, embedding, status 'complete', updated_at, line_order) per result line."""
    p = lines.select("file_path", "line", "line_order", F.from_json("line", EMBEDDING_LINE).alias("j"))
    p = p.select("file_path", "line", "line_order", request_id(F.col("j.custom_id")).alias("id"),
                 _vector(p).alias("embedding"))
    ok = F.col("id").isNotNull() & F.col("embedding").isNotNull()
    return _split_good_bad(p, ok, [F.col("id"), F.col("embedding"),
                                   F.lit(STATUS_COMPLETE).alias("status"),
                                   F.lit(as_of).cast("timestamp").alias("updated_at"), F.col("line_order")])


def read_embedding_output(spark: SparkSession, path: str,
                          as_of: datetime | str) -> tuple[DataFrame, DataFrame]:
    return parse_embedding_lines(_lines(spark, path), as_of)


def parse_embedding_lines_table(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Table variant: id from the second ``-`` piece, vector possibly a
    JSON string, ``is_complete = true``."""
    p = lines.select("file_path", "line", "line_order", F.from_json("line", EMBEDDING_LINE).alias("j"))
    p = p.select("file_path", "line", "line_order", request_id(F.col("j.custom_id"), 1).alias("id"),
                 _vector(p).alias("embedding"))
    ok = F.col("id").isNotNull() & F.col("embedding").isNotNull()
    return _split_good_bad(p, ok, [F.col("id"), F.col("embedding"), F.lit(True).alias("is_complete"), F.col("line_order")])


def read_embedding_output_table(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return parse_embedding_lines_table(_lines(spark, path))


# --- A7 --------------------------------------------------------------------------------------------------

def request_line(id_col: Column, context: Column) -> Column:
    """One embedding request as a JSON line."""
    return F.to_json(F.struct(
        F.concat(F.lit(REQUEST_ID_PREFIX), id_col.cast("string")).alias("custom_id"),
        F.lit(REQUEST_METHOD).alias("method"),
        F.lit(REQUEST_URL).alias("url"),
        F.struct(F.lit(REQUEST_MODEL).alias("model"), context.alias("input")).alias("body")))


def embedding_requests(batched: DataFrame) -> DataFrame:
    """(batch_no, id, line) for batched embeddings (id, context, batch_no)."""
    return batched.select("batch_no", "id", request_line(F.col("id"), F.col("context")).alias("line"))


def write_embedding_requests(batched: DataFrame, path: str, batch_size: int = BATCH_SIZE) -> None:
    """A7 sink: JSONL text files of one batch each, 1,000 batches to a folder.

    A shuffle brings each batch to one task, which writes its batches in order
    and starts a new file every ``batch_size`` lines; all batches but the very
    last are full, so files and batches coincide. The number of folders and of
    open files stays small however many batches there are."""
    (embedding_requests(batched).withColumn("batch_group", F.floor(F.col("batch_no") / 1000))
     .repartition("batch_no").sortWithinPartitions("batch_group", "batch_no", "id")
     .select("batch_group", "line").write.mode("overwrite").option("maxRecordsPerFile", batch_size)
     .partitionBy("batch_group").text(path))
