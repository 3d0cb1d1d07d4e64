"""Helpers shared by the operators: staged tables, the package on the
executors, null-safe views of the input."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import io
import os
import shutil
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blockload.session import new_path

# Fixed value: white space that separates words in every word-based operator
# (space, and the code points 9 to 13).
WORD = r"[^\x20\x09-\x0D]+"

_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 2000       # rows of an Arrow batch, as texts are long

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Put this package on the executors' Python path, once per application.

    Functions of this package run in Python workers, which import them by
    name; Spark's own file distribution brings the package to executors that
    have no copy of it.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    folder = tempfile.mkdtemp(prefix="blockload-py-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)   # executors that come later still fetch it
    path = os.path.join(folder, "blockload_pkg.zip")
    with open(path, "wb") as f:  # on the driver only; Spark hands it to the executors
        f.write(buffer.getvalue())
    spark.sparkContext.addPyFile(path)
    # Rows are whole texts here: fewer to a batch than Spark's default.
    if int(spark.conf.get(_BATCH_ROWS, "10000")) > BATCH_ROWS:
        spark.conf.set(_BATCH_ROWS, str(BATCH_ROWS))
    _SHIPPED.add(app)


def tidy(run: Callable, *caches: dict) -> Callable:
    """``run`` over a task's batches; when the task ends, the worker, which
    waits for other tasks, gives back the memory that it no longer needs."""
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            for cache in caches:
                cache.clear()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # only where the C library has it
                ctypes.CDLL(None).malloc_trim(0)
    return whole


def staged(df: DataFrame, kind: str) -> DataFrame:
    """``df`` written to the shared work folder and read back: it is computed
    once, and its lineage ends there, whatever executors are lost later."""
    spark = df.sparkSession
    path = new_path(spark, kind)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished jobs now. Its cleaner
    follows the driver's garbage collection, which an idle driver may not see
    for half an hour, while the files fill the executors' disks. A query more
    goes before: Spark's listener keeps the last one, with its shuffles, until
    the next has come."""
    spark.sql("SELECT 1").collect()
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def unstage(*frames: DataFrame) -> None:
    """Remove the files of staged tables that no later job reads."""
    for df in frames:
        spark = df.sparkSession
        jvm = spark.sparkContext._jvm
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns only, so that extra columns, whatever their names,
    never clash with those an operator adds."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def sheltered(df: DataFrame, *needed: str) -> tuple[DataFrame, list[Column]]:
    """``df`` with every column but the ``needed`` ones under a name that no
    operator uses, and the columns that give it back its own."""
    names = {c: c if c in needed else f"__own{i}" for i, c in enumerate(df.columns)}
    return (df.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]),
            [F.col(n).alias(c) for c, n in names.items()])


def partitions_for(n_rows: int, rows_each: int) -> int:
    return max(1, -(-n_rows // rows_each))
