"""Helpers shared by the corpus operators: stored cut points, streaming of sorted groups, input shaping."""

from __future__ import annotations

import ctypes
import os
import shutil
import tempfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.session import scratch_path


_handed: set[str] = set()


def hand_to_workers(spark: SparkSession) -> None:
    """Give the package to the Python workers of a local session whose path lacks it; clusters get it with the job."""
    context = spark.sparkContext
    if context.applicationId in _handed:
        return
    _handed.add(context.applicationId)
    root = Path(__file__).resolve().parents[2]
    known = {Path(p).resolve() for p in [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)] if p}
    if context.master.startswith("local") and root not in known:
        context.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp()}/tenderlake", "zip", root, "tenderlake"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    hand_to_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write the rows to the shared folder and read them from there.

    Cuts the lineage with a table that survives lost executors, and gives the
    joins that follow plain scans, whose skewed partitions Spark can split.
    """
    path = scratch_path(df.sparkSession, label)
    _made.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_made: list[str] = []


def made() -> int:
    """A mark: tables stored from here on can be released together."""
    return len(_made)


def release(result: DataFrame, mark: int) -> None:
    """Delete the tables stored since the mark but the last, which is ``result`` and so no longer needs them."""
    spark = result.sparkSession
    for path in _made[mark:-1]:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    del _made[mark:-1]


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column; null counts as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def binary_text(name: str = "text") -> Column:
    """A text column as UTF-8 bytes, null as empty."""
    return F.coalesce(F.col(name).cast("binary"), F.lit(b""))


def chunks(batches: Iterator[pa.RecordBatch], rows: int = 100_000) -> Iterator[pa.Table]:
    """The batches of a task, put together to tables of about ``rows`` rows."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def whole_groups(batches: Iterator[pa.RecordBatch], key: str, rows: int = 100_000) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by ``key``: a group never spans two tables."""
    rest = None
    for part in chunks(batches, rows):
        if rest is not None:
            part = pa.concat_tables([rest, part])
        keys = column(part, key)
        cut = int(np.searchsorted(keys, keys[-1], side="left"))
        if cut:
            yield part.slice(0, cut)
        rest = part.slice(cut)
    if rest is not None and rest.num_rows:
        yield rest


def column(part: pa.Table | pa.RecordBatch, name: str) -> np.ndarray:
    return part.column(name).to_numpy(zero_copy_only=False) if isinstance(part, pa.RecordBatch) \
        else part.column(name).to_numpy()


def text_batches(batches: Iterator[pa.RecordBatch], size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``size`` bytes each, so that working memory follows texts, not rows."""
    for batch in batches:
        start = 0
        step = max(1, int(batch.num_rows * size / max(batch.nbytes, 1)))
        while start < batch.num_rows:
            yield batch.slice(start, step)
            start += step
    give_back()


def give_back() -> None:
    """Return what Arrow and the C library keep of freed memory: a Python worker lives on for other tasks, a driver for other stages."""
    pa.default_memory_pool().release_unused()
    # Small arrays come from the heap of the C library, which only glibc can be asked to shrink.
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
