"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from pubspark.session import ensure_checkpoint_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name for intermediate tables under the session's ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage: a lost executor costs the tasks that read the table, never the work
    that made it.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._folder = path
    return table


def discard(*tables: DataFrame | None) -> None:
    """Delete what :func:`materialize` wrote for these tables, once nothing reads them any more: neither
    a DataFrame still to be run nor the remake of a lost task. Also lets the driver notice that
    finished jobs' shuffle files are free."""
    for table in tables:
        folder = getattr(table, "_folder", None)
        if folder is not None:
            sc = table.sparkSession.sparkContext
            path = sc._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
            sc._jvm.System.gc()


@contextmanager
def small_batches(spark: SparkSession, size: str = "8m") -> Iterator[None]:
    """Within it, Arrow batches of jobs hold about ``size`` bytes at most, so that wide rows (sets,
    leaves) take little memory beside the heap; the session's own setting comes back."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def released(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run``, after which a worker gives the memory it no longer needs back to the system; workers
    live on for other tasks and stages."""
    def task(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
            if trim is not None:
                trim(0)
    return task


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, prefixed until no column of ``df`` has it (column names ignore case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The column's strings; null reads as the empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]


def as_batch(columns: Iterable, schema: pa.Schema) -> pa.RecordBatch:
    arrays = [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type)
              for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
