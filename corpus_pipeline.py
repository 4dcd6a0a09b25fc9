"""The corpus pipeline: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet and read again as the next stage's docs. All but the last return the
columns of documents; every other column a table may have is carried along.

Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing
column names: as each operator's module says. A document that the mix reads
several times is packed as often.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm import exact_dedup, mixing, packing, quality, simhash
from docweave.llm.common import stage, table
from docweave.llm.queries import LENGTH, word_vocab


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier, learnt from ``labels``; documents it rejects go."""
    return quality.drop_poor_documents(docs, table(spark, sf_dir, "labels"))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_exact_duplicates(docs)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: 3-word shingles, at most 2 bits apart."""
    return simhash.drop_near_duplicates(docs, words=3, max_bits=2)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in the shares of their targets: documents as often as the mix reads them."""
    return mixing.repeat_documents(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) per piece."""
    pieces = packing.pack(docs, word_vocab(), LENGTH)
    return pieces.select(F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


STAGES = [("quality_classifier", good_documents), ("exact_dedup", distinct_documents), ("simhash_near_dedup", no_near_copies),
          ("mixing", mixed_sources), ("packing", packed_sequences)]

#: classifier, fingerprint and tokenizer stages have no SQL form; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stage(docs, name)
    return docs
