"""The shared scratch folder: where iterative operators write what later steps read again."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Rows that Spark hands to Python at once where they hold whole texts.
BATCH_TEXTS = 500
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; a temporary one where none is set and all of Spark is on this machine, as in tests."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def staged(df: DataFrame, name: str) -> DataFrame:
    """df written once to the shared folder and read again: the lineage ends there, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    found = spark.read.schema(df.schema).parquet(path)
    found.folder = path
    return found


def discard(*frames: DataFrame) -> None:
    """Deletes what staged() wrote for these frames; nothing that is still to be computed may read it."""
    for df in frames:
        context = df.sparkSession.sparkContext
        where = context._jvm.org.apache.hadoop.fs.Path(df.folder)
        where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """df as staged() gives it; itself if it comes from there."""
    return df if "folder" in vars(df) else staged(df, name)


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_TEXTS) -> Iterator[None]:
    """What is run in here hands at most so many rows to Python at once, and the session has its own setting again behind it. Spark's default, 10,000
    texts, takes tens of MB a task in direct buffers of the JVM, which grow by doubling, and as much in Python; neither gives all of it back."""
    before = spark.conf.get(ARROW_ROWS)
    if not 0 < int(before) <= rows:
        spark.conf.set(ARROW_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, before)


def unused(df: DataFrame, name: str) -> str:
    """name, with as many underscores behind it as keep it apart from every column of df, in either case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
