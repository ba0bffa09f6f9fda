"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words as the contracts define them: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores behind it until no column of df has it."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share. Where none is set, a local session uses its warehouse; a
    cluster must set spark.checkpoint.dir."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = sc._jsc.sc().getCheckpointDir()
        path = path.get() if path.isDefined() else None
    if not path:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
    return path.rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def materialised(df: DataFrame, label: str) -> DataFrame:
    """Write once as Parquet in the shared folder and read back (columnar, compressed)."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def sliced(batches, max_bytes: int = 8 << 20):
    """Cut Arrow batches so that a slice holds few bytes, or one long row."""
    for batch in batches:
        rows, start = batch.num_rows, 0
        if not rows:
            continue
        step = max(1, int(rows * max_bytes / max(batch.nbytes, 1)))
        while start < rows:
            yield batch.slice(start, step)
            start += step


def discard(df: DataFrame) -> None:
    """Delete a table that materialised() wrote and nothing reads any more."""
    files = df.inputFiles()
    if files:
        remove(df.sparkSession, files[0].rsplit("/", 1)[0])


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, through Hadoop's file systems."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner delete shuffle files of finished stages now, not some time later."""
    gc.collect()
    spark._jvm.System.gc()


def small_batches(spark: SparkSession, rows: int = 1000, size: int = 16 << 20) -> None:
    """Hand texts to Python in batches of few rows and bytes, so that long texts do not pile up."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def returning(run):
    """Wrap a function of Arrow or pandas batches: at the end of a task its worker, which Spark uses
    again for other stages, gives memory that it no longer needs back to the machine."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def give_back() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)
