"""Session helpers: a local session for tests/bench, the checkpoint folder,
and the partitioning knobs the operators read."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "docweave") -> SparkSession:
    """A local session configured the way the operators expect.

    On a cluster, build the session yourself; the operators only rely on
    AQE being on (it is by default) and on ``spark.checkpoint.dir`` when a
    job cuts lineage.
    """
    os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
        # long texts: also cap the bytes of each Arrow batch sent to Python
        .config("spark.sql.execution.arrow.maxBytesPerBatch", str(64 * 1024 * 1024))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    Reads ``spark.checkpoint.dir`` from the session (the cluster's shared
    folder). Only a local-mode session without one gets a scratch folder,
    which is the test setting.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="docweave-ckpt-")
    sc.setCheckpointDir(path)
    return path


def spread_scan(df):
    """Deal a plain file scan with fewer splits than cores (a few large files of
    one row group each) over all cores, for work that is heavy per row. For
    scans only: it asks the scan for its number of splits. No operator depends
    on the order of its input rows, so this changes no result."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores * 2) if df.rdd.getNumPartitions() < cores else df


# --- staged tables ---------------------------------------------------------------

_scopes = threading.local()


@contextmanager
def temporary_tables(spark: SparkSession):
    """Tables staged inside this block (by this thread) are deleted when it ends.
    Jobs and stream epochs each open their own, so none deletes another's. Write
    or collect all results before the block ends."""
    stack = _scopes.__dict__.setdefault("stack", [])
    stack.append([])
    try:
        yield
    finally:
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for name in stack.pop():
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(conf).delete(path, True)


def stage(df):
    """Cut lineage: write ``df`` once as a parquet table in the shared
    checkpoint folder (``spark.checkpoint.dir``) and read it back.

    One write job, and later plans start from a file scan with real sizes, so
    AQE can choose joins from them. A lost executor re-reads the files. The
    table goes with the enclosing ``temporary_tables`` block; without one it
    stays in the session's checkpoint folder."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if stack := _scopes.__dict__.get("stack"):
        stack[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)
