"""Tables bucketed by their key, so that keyed updates do not shuffle them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_bucketed(df: DataFrame, name: str, key: str = "id", buckets: int = 64, path: str | None = None) -> DataFrame:
    """Write ``df`` as the table ``name`` in ``buckets`` buckets of ``key``, one
    sorted file each, and return the table.

    A keyed update (``update_by_key``, ``delete_by_ids``, ``lookup``) of the
    returned table shuffles only its other side, and its result still lies in
    the same buckets: written under the next version's name with the same key
    and number of buckets, it is not shuffled either. Choose ``buckets`` so that
    one holds a few hundred MB; it is part of the table and kept by every version.
    A table cannot be overwritten while it is read: give each version a name.
    ``path``: folder of an external table (default: the session's warehouse).
    """
    if buckets < 1:
        raise ValueError("a table needs at least one bucket")
    # the exchange goes away where df already lies in these buckets
    writer = (df.repartition(buckets, F.col(key)).write.format("parquet").mode("overwrite")
              .bucketBy(buckets, key).sortBy(key))
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)
