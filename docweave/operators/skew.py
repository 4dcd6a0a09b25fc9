"""Joins of a large side with a lookup whose keys are unique, for hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

#: a key with more than one part in so many of the rows is heavy (so there are fewer heavy keys than that)
HEAVY_PARTS = 256
#: the rows of a heavy key are dealt over so many join keys
SALTS = 32


def _key_hash(df: DataFrame, key: str) -> Column:
    """Equal for equal keys, whatever the width of an integer."""
    col = F.col(key)
    return F.xxhash64(col.cast("bigint") if isinstance(df.schema[key].dataType, IntegralType) else col)


def heavy_hashes(rows: DataFrame, key: str, parts: int = HEAVY_PARTS) -> list[int]:
    """Hashes of the keys that hold more than 1/``parts`` of ``rows``, counted
    over all of them (null is a key too). At most ``parts`` numbers reach the
    driver, whatever the table's size; counts are combined in each task first."""
    most = rows.count() // parts
    counts = rows.groupBy(_key_hash(rows, key).alias("h")).count()
    return sorted(r.h for r in counts.where(F.col("count") > most).select("h").collect())


def join_unique(rows: DataFrame, lookup: DataFrame, key: str, spread: list[str], how: str = "inner",
                parts: int = HEAVY_PARTS, salts: int = SALTS) -> DataFrame:
    """``rows`` joined to ``lookup`` (one row per ``key``), the same rows as the
    plain join. Rows of a heavy key are dealt by a hash of ``spread`` over
    ``salts`` join keys, and only the lookup rows of heavy keys are repeated, so
    no task holds a hot key alone and nothing is broadcast beyond the bounded
    list of hashes. A light key that shares a heavy key's hash is dealt as well,
    on both sides, which changes no result.

    ``rows`` is read twice (keys only the first time): stage it when it is
    costly to compute. Null keys match nothing; in a left join they are spread
    like any other heavy key. Keys of two different types, other than integers,
    are compared by Spark's coercion in a plain join."""
    a, b = rows.schema[key].dataType, lookup.schema[key].dataType
    alike = a == b or isinstance(a, IntegralType) and isinstance(b, IntegralType)
    heavy = heavy_hashes(rows, key, parts) if alike else []
    if not heavy:
        return rows.join(lookup, key, how)
    zero, last = F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")
    dealt = rows.withColumn("_salt", F.when(_key_hash(rows, key).isin(heavy), F.pmod(F.xxhash64(*spread), F.lit(salts)))
                            .otherwise(zero))
    repeated = lookup.withColumn("_salt", F.explode(F.when(_key_hash(lookup, key).isin(heavy), F.sequence(zero, last))
                                                    .otherwise(F.array(zero))))
    return dealt.join(repeated, [key, "_salt"], how).drop("_salt")
