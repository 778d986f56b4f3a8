"""Session set-up and durable cut points."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job wants. Sizes (memory, shuffle partitions) belong to the
# cluster and are left to spark-submit.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even where that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app_name: str = "tenderlake", master: str | None = None, **conf) -> SparkSession:
    """Session with the defaults above; keyword pairs override them (dots as ``__``)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a
    cluster a machine-local folder would be lost with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if folder is None:
        folder = context.getConf().get("spark.checkpoint.dir")
    if folder is None:
        folder = context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tenderlake-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Write the rows once and read them from there on.

    Used where a plan is consumed more than once and a recomputation could
    place rows differently (range partitioning samples its input).
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)



def stored(df: DataFrame, label: str) -> DataFrame:
    """Write the rows below the shared folder and read them from there; unlike a checkpoint the table has known size."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    _scratch().append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_written = threading.local()


def _scratch() -> list[str]:
    """Paths written by this thread: fits that run side by side delete their own."""
    if not hasattr(_written, "paths"):
        _written.paths = []
    return _written.paths


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A fresh path that goes like what ``stored`` writes."""
    path = scratch_path(spark, label)
    _scratch().append(path)
    return path


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Deletes what ``stored`` writes inside the block when the block ends: nothing lazy may leave it."""
    mark = len(_scratch())
    try:
        yield
    finally:
        for path in _scratch()[mark:]:
            delete(spark, path)
        del _scratch()[mark:]


def delete(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def folders(spark: SparkSession, path: str, key: str, complete: bool = True) -> list[str]:
    """Values of the ``key=value`` folders below a path; ``complete`` ones are those that Spark has marked as written."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    top = hadoop.Path(path)
    store = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(top):
        return []
    found = [s.getPath() for s in store.listStatus(top) if s.isDirectory() and s.getPath().getName().startswith(f"{key}=")]
    return sorted(p.getName()[len(key) + 1:] for p in found if not complete or store.exists(hadoop.Path(p, "_SUCCESS")))
