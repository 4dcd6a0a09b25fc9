"""Table operators: lookups, predicate scans, inserts with id allocation,
keyed partial updates (last wins), deletes, and consecutive numbering.

Mutations return a new DataFrame (parquet tables cannot be updated in
place); the jobs write it as a new table version.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docweave.operators.skew import join_unique
from docweave.session import stage


# --- A1 / A2 / A3 / A11 ---------------------------------------------------------

def lookup(df: DataFrame, ids: DataFrame, columns: list[str] | None = None,
           key: str = "id") -> DataFrame:
    """A1: rows whose key is in ``ids`` (a one-column frame); unmatched ids vanish.

    A left-semi join: Spark hashes or broadcasts the id side (AQE decides on
    its measured size) and never duplicates rows.
    """
    id_col = ids.columns[0]
    # a semi join never repeats a row, so the id side needs no distinct (no extra shuffle)
    matched = df.join(ids.select(F.col(id_col).alias(key)), key, "left_semi")
    return matched.select(*(columns or df.columns))


def filter_table(df: DataFrame, predicate: str | Column) -> DataFrame:
    """A2: free predicate; pushed to the scan when it touches plain columns."""
    return df.where(predicate)


def child_ids(children: DataFrame, parent_ids: DataFrame, parent_key: str = "content_id_id",
              child_key: str = "id") -> DataFrame:
    """A3: ids of the children of the given parents, nulls dropped."""
    pid = parent_ids.columns[0]
    return (children.join(parent_ids.select(F.col(pid).alias(parent_key)), parent_key, "left_semi")
            .where(F.col(child_key).isNotNull()).select(child_key))


def delete_by_ids(df: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose key is not in ``ids``."""
    id_col = ids.columns[0]
    return df.join(ids.select(F.col(id_col).alias(key)), key, "left_anti")


# --- E1 core: consecutive numbering without a single-partition window ------------------

def with_row_index(df: DataFrame, order_by: list[str], index_col: str = "row_index",
                   num_partitions: int | None = None) -> DataFrame:
    """Add a 0-based consecutive index in ``order_by`` order.

    ``order_by`` must be a unique key (ties would be numbered arbitrarily); any
    orderable types. Spark range-partitions and sorts the rows by the key (its
    own bounded sample balances the ranges; a hot value of one key column is
    split by the others). The sorted partitions are written once, each row with
    its partition and its place in it, so the numbering cannot change when a
    task is recomputed. A partition's offset is the size of all earlier ones:
    one row per partition. ``num_partitions`` sets the number of ranges; without
    it Spark's shuffle partitions and AQE do.
    """
    ranged = (df.repartitionByRange(num_partitions, *order_by) if num_partitions
              else df.repartitionByRange(*order_by))
    place = F.monotonically_increasing_id()       # partition << 33 | place in the sorted partition
    placed = stage(ranged.sortWithinPartitions(*order_by).withColumn("_place", place))
    part = F.shiftright("_place", 33)
    inside = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg((F.max(inside) + 1).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = sizes.select("_part", (F.sum("_n").over(before) - F.col("_n")).alias("_offset"))
    return (placed.withColumn("_part", part)
            .join(F.broadcast(offsets), "_part")          # one row of two numbers per partition
            .withColumn(index_col, F.col("_offset") + inside)
            .drop("_part", "_place", "_offset"))


def assign_batches(df: DataFrame, order_by: list[str], size: int,
                   batch_col: str = "batch_no", num_partitions: int | None = None) -> DataFrame:
    """Consecutive groups of at most ``size`` rows in ``order_by`` order."""
    indexed = with_row_index(df, order_by, "_row", num_partitions)
    return indexed.withColumn(batch_col, F.floor(F.col("_row") / F.lit(size)).cast("bigint")).drop("_row")


# --- A8: append with generated ids -------------------------------------------------------

def next_id_base(target: DataFrame, key: str = "id") -> Column:
    """Largest stored id (0 when empty) as a scalar subquery."""
    return target.select(F.coalesce(F.max(key), F.lit(0)).cast("bigint")).scalar()


def allocate_ids(rows: DataFrame, target: DataFrame, order_by: list[str],
                 key: str = "id", num_partitions: int | None = None) -> DataFrame:
    """New ids ``max(target.id) + 1 + rank`` for ``rows`` in ``order_by`` order."""
    indexed = with_row_index(rows, order_by, "_row", num_partitions)
    return (indexed.withColumn(key, next_id_base(target, key) + F.col("_row") + F.lit(1))
            .drop("_row"))


def append_rows(target: DataFrame, rows: DataFrame, order_by: list[str],
                as_of: datetime | str | None = None, key: str = "id") -> DataFrame:
    """``target`` with ``rows`` appended under new ids. ``created_at`` and
    ``updated_at`` are set to ``as_of`` when given; missing target columns are
    null."""
    new = allocate_ids(rows, target, order_by, key)
    if as_of is not None:
        ts = F.lit(as_of).cast("timestamp")
        new = new.withColumn("created_at", ts).withColumn("updated_at", ts)
    aligned = new.select(*[
        F.col(f.name).cast(f.dataType) if f.name in new.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in target.schema.fields])
    return target.unionByName(aligned)


# --- A9 / A10: keyed partial updates --------------------------------------------------------

def last_update_per_key(updates: DataFrame, key: str, order_col: str) -> DataFrame:
    """One row per key: the values of the latest update by ``order_col`` (any
    orderable type, structs too). A null order is earlier than any other; equal
    orders fall back to a hash of the values, so the result is defined.

    ``max_by`` is a partial aggregate: each task combines its own rows before
    the shuffle, so a hot key sends one row per task, not all its updates.
    """
    value_cols = [c for c in updates.columns if c not in (key, order_col)]
    order = F.struct(F.col(order_col).isNotNull(), F.col(order_col), F.xxhash64(*value_cols))
    packed = updates.select(key, order.alias("_ord"), F.struct(*value_cols).alias("_v"))
    return (packed.groupBy(key).agg(F.max_by("_v", "_ord").alias("_v"))
            .select(key, *[F.col("_v")[c].alias(c) for c in value_cols]))


def update_by_key(target: DataFrame, updates: DataFrame, key: str = "id",
                  order_col: str | None = None, as_of: datetime | str | None = None,
                  unique: bool = False, changed_only: bool = False, spread: list[str] | None = None) -> DataFrame:
    """Apply partial row updates; repeated keys: the last wins; unknown
    keys do nothing. Only the columns present in ``updates`` change.
    ``updated_at`` is set on matched rows when ``as_of`` is given.

    ``order_col`` orders repeated updates and is required, unless the caller
    knows the keys of ``updates`` to be ``unique`` (then nothing is aggregated).
    ``changed_only`` returns the matched rows only, for stores that keep changes.
    ``spread`` names target columns by which the rows of a hot key are dealt
    over many tasks; not needed where the key is unique in the target.
    """
    if order_col is None and not unique:
        raise ValueError("updates need order_col, or unique=True")
    latest = updates if unique else last_update_per_key(updates, key, order_col)
    value_cols = [c for c in latest.columns if c != key and c in target.columns]
    renamed = latest.select(key, F.lit(True).alias("_hit"),
                            *[F.col(c).alias(f"_new_{c}") for c in value_cols])
    how = "inner" if changed_only else "left"
    joined = join_unique(target, renamed, key, spread, how) if spread else target.join(renamed, key, how)
    out = []
    for f in target.schema.fields:
        c = f.name
        if c in value_cols:
            out.append(F.when(F.col("_hit"), F.col(f"_new_{c}").cast(f.dataType)).otherwise(F.col(c)).alias(c))
        elif c == "updated_at" and as_of is not None:
            out.append(F.when(F.col("_hit"), F.lit(as_of).cast(f.dataType)).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return joined.select(*out)


def update_by_content(target: DataFrame, values: DataFrame, content_key: str = "content_id_id",
                      order_col: str | None = None, as_of: datetime | str | None = None,
                      unique: bool = False) -> DataFrame:
    """A10: the same values on every row sharing a content id.

    The per-content update side has one row per content id; target rows of a
    content that holds much of the table are dealt over many tasks by their id
    (``skew.join_unique``).
    """
    spread = ["id"] if "id" in target.columns else [c for c in target.columns if c != content_key]
    return update_by_key(target, values, key=content_key, order_col=order_col, as_of=as_of, unique=unique,
                         spread=spread or None)
