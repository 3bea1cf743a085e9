"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Settings the jobs rely on; a cluster may override everything but the zone.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Streaming state beyond the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(app_name: str = "fieldspark", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or reuse) a session with the settings the jobs rely on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Pin the zone: raw tables are zone-less UTC, and truncation must not move them."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="fieldspark-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(base)
    return base


def work_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the application's own part of the shared folder.

    That part is removed when the application's JVM ends; results to keep go elsewhere.
    """
    context = spark.sparkContext
    root = f"{shared_dir(spark).rstrip('/')}/fieldspark-{context.applicationId}"
    folder = context._jvm.org.apache.hadoop.fs.Path(root)
    files = folder.getFileSystem(context._jsc.hadoopConfiguration())
    if not files.exists(folder):
        files.mkdirs(folder)
        files.deleteOnExit(folder)
    return f"{root}/{name}-{uuid.uuid4().hex}"


def checkpointed(df):
    """Reliable checkpoint of a small intermediate result."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


_stored = threading.local()


@contextmanager
def passing(spark: SparkSession):
    """What this thread stores meanwhile is removed at the end, if not asked to last.

    Large results of one step, of which only a small one goes on, do not add up on disk so.
    """
    stack = _stored.__dict__.setdefault("stack", [])
    stack.append([])
    try:
        yield
    finally:
        for path in stack.pop():
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def _new_path(spark: SparkSession, name: str, lasting: bool = False) -> str:
    """A path for a stored result, noted with the :func:`passing` block it belongs to: a lasting one with the next outer block."""
    path = work_path(spark, name)
    stack = _stored.__dict__.get("stack", [])[: -1 if lasting else None]
    if stack:
        stack[-1].append(path)
    return path


def stored(df, name: str, balanced: bool = False, codec: str = "snappy", lasting: bool = False):
    """Write a result that is read several times to the shared folder, and read it back.

    Unlike a cache this survives lost executors and stays columnar. ``balanced`` evens out
    the files first: one shuffle, worth it before many passes such as training.
    """
    spark = df.sparkSession
    path = _new_path(spark, name, lasting)
    (df.hint("rebalance") if balanced else df).write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_files(df, name: str, rows: int) -> list[tuple[str, int]]:
    """Write a result to the shared folder in files of up to ``rows`` rows; gives their paths and numbers of rows."""
    spark = df.sparkSession
    path = _new_path(spark, name)
    df.write.option("maxRecordsPerFile", rows).parquet(path)
    written = spark.read.schema(df.schema).parquet(path).groupBy(F.col("_metadata.file_name").alias("name")).agg(F.count("*").alias("n"))
    return [(f"{path}/{row['name']}", row["n"]) for row in written.collect()]
