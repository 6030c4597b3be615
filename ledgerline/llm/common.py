"""Helpers shared by the operators: table readers, shared scratch tables, and blob files.

Scratch tables live below the folder that the cluster names in ``spark.checkpoint.dir``. Only a
local-mode session without that setting gets a folder of its own.
"""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of one Arrow batch sent to Python: bounds a worker's memory where texts are long.
BATCH_ROWS = 500

_SHIPPED: set[str] = set()
_SCRATCH: list[str] = []


def prepare(spark: SparkSession) -> None:
    """Bound Arrow batches, and give executors this package (once for each application)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    top = os.path.dirname(package)
    archive = os.path.join(tempfile.mkdtemp(), "ledgerline_package.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, top))
    spark.sparkContext.addPyFile(archive)  # read by the driver alone; Spark's file server hands it out
    _SHIPPED.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is unset: it must name a folder that driver and executors share")
    root = tempfile.mkdtemp(prefix="ledgerline-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    path = f"{shared_root(spark)}/ledgerline/{name}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


def scratch_mark() -> int:
    """A mark for ``scratch_since``."""
    return len(_SCRATCH)


def scratch_since(mark: int) -> list[str]:
    return _SCRATCH[mark:]


def delete(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch tables that nothing reads any more."""
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(rows: DataFrame, group: list[str], order: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """Places within groups of any size, without a task that holds a group.

    Rows are sorted over the cluster by ``group`` and ``order`` (nulls first; equal rows are split too) and
    written with ``key``, a unique number that ascends in that order, and ``part``, their range. The second
    frame has a row per range and group: ``part``, the group, ``first`` (the least key there), ``n`` (rows
    there) and ``start`` (rows of the group in ranges before). A row's place in its group is key - first + start."""
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    keys = [*group, *order, "_tie"]
    ranged = tied.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    ranged = ranged.withColumn("key", F.monotonically_increasing_id())
    written = materialize(ranged.withColumn("part", F.shiftright("key", 33)), name)
    runs = written.groupBy("part", *group).agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("first"))
    before = Window.partitionBy(*(group or [F.lit(0)])).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return written, runs.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))


def in_training(column: str, folds: int) -> F.Column:
    """True where crc32(column as text) mod ``folds`` is not 0. A null id is never training."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % folds != 0, F.lit(False))


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; null reads as empty."""
    return [x or "" for x in batch.column(column).to_pylist()]


def tidy(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``work`` as a task's function that hands freed memory back to the system when it ends. Spark keeps a Python
    worker for later tasks, and without this the worker keeps the most that any of its tasks has held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
        if trim:
            trim(0)

    return run


# Blob files. Spark's text writer appends ``lineSep`` to each row. A blob whose last byte is NUL is
# written without that byte, and the separator NUL puts it back. So any binary format whose blobs
# end in NUL is written byte for byte by Spark's own committed writer, to any Hadoop store.


def write_blobs(df: DataFrame, path: str, per_file: int = 1) -> None:
    """Write a frame of one binary column ``blob``; every blob ends in a NUL byte. Each output
    file holds at most ``per_file`` blobs, in the order of their partition."""
    body = F.expr("substring(blob, 1, octet_length(blob) - 1)").cast("string").alias("value")
    df.select(body).write.option("lineSep", "\0").option("maxRecordsPerFile", per_file).text(path)


def read_blobs(spark: SparkSession, path: str) -> DataFrame:
    """``path``, ``length``, ``content`` of every blob file."""
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "length", "content")
    )
