"""Table state that lasts between the epochs of a stream.

A table is a base plus, for each epoch, the rows that epoch changed or added:

    <root>/<table>/base=<n>/      the table as it stood before epoch n
    <root>/<table>/epoch=<n>/     rows changed (keyed tables) or added by epoch n

Epoch N always reads the largest base <= N and the epochs from it up to N - 1,
never its own folder, so a replayed epoch sees what it saw before and writes the
same rows to the same folder. ``compact`` writes a new base apart from the
stream. Folders without ``_SUCCESS`` (a write that did not finish) do not count.

One store belongs to one stream. Folder lists come from the Hadoop file system,
so any shared storage works.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class EpochTables:
    """``keys``: table name -> its unique key, or None for a table that only grows."""

    def __init__(self, spark: SparkSession, root: str, keys: dict[str, str | None]) -> None:
        self.spark, self.root, self.keys = spark, root.rstrip("/"), keys

    def create(self, name: str, rows: DataFrame) -> None:
        """Write a table's first base, unless it has one."""
        if not self._folders(name, "base"):
            rows.write.mode("overwrite").parquet(f"{self.root}/{name}/base=0")

    def _folders(self, name: str, kind: str) -> list[int]:
        jvm = self.spark.sparkContext._jvm
        top = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        fs = top.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(top):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(top)]
        done = [n for n in names if fs.exists(jvm.org.apache.hadoop.fs.Path(top, f"{n}/_SUCCESS"))]
        return sorted(int(n.partition("=")[2]) for n in done if n.startswith(f"{kind}="))

    def next_epoch(self) -> int:
        """The epoch after the last one written."""
        return max((n + 1 for name in self.keys for n in self._folders(name, "epoch")), default=0)

    def read(self, name: str, before: int | None = None) -> DataFrame:
        """The table as it stands before epoch ``before`` (default: after all)."""
        before = self.next_epoch() if before is None else before
        start = max(n for n in self._folders(name, "base") if n <= before)
        base = self.spark.read.parquet(f"{self.root}/{name}/base={start}")
        epochs = [n for n in self._folders(name, "epoch") if start <= n < before]
        if not epochs:
            return base
        later = [self.spark.read.schema(base.schema).parquet(f"{self.root}/{name}/epoch={n}").withColumn("_epoch", F.lit(n)) for n in epochs]
        rows = later[0]
        for one in later[1:]:
            rows = rows.unionByName(one)
        key = self.keys[name]
        if key is None:
            return base.unionByName(rows.drop("_epoch"))
        # an epoch holds a key once, so the latest epoch of a key names its row
        last = rows.groupBy(key).agg(F.max("_epoch").alias("_epoch"))
        return base.join(last.select(key), key, "left_anti").unionByName(rows.join(last, [key, "_epoch"], "left_semi").drop("_epoch"))

    def write(self, epoch: int, rows: dict[str, DataFrame]) -> None:
        """Write what an epoch changed; the columns of stored tables are aligned to their base."""
        for name, df in rows.items():
            if name in self.keys and (bases := self._folders(name, "base")):
                fields = self.spark.read.parquet(f"{self.root}/{name}/base={bases[0]}").schema.fields
                df = df.select(*[F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
            df.write.mode("overwrite").parquet(f"{self.root}/{name}/epoch={epoch}")

    def compact(self, name: str, before: int | None = None) -> None:
        """Write a new base; earlier bases and epochs are no longer read. Call it
        for epochs the stream has committed (it never replays those)."""
        before = self.next_epoch() if before is None else before
        if before not in self._folders(name, "base"):
            self.read(name, before).write.mode("overwrite").parquet(f"{self.root}/{name}/base={before}")
