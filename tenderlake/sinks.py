"""Writers. Counts come from an observation of the write, not a second pass."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from tenderlake.operators import layers, sketches
from tenderlake.schema import ETL_LOG
from tenderlake.session import delete, folders


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> str:
    """Parquet with mode overwrite, append, ignore or error."""
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return path


def write_lake_layer(df: DataFrame, lake: str, layer: str, run_id: str) -> str:
    """One run of a layer: ``{lake}/{layer}/run_id={run_id}``.

    A repeated run overwrites its own folder; readers of the layer prune by run.
    """
    return write_parquet(df, f"{lake.rstrip('/')}/{layer}/run_id={run_id}")


def write_table(df: DataFrame, name: str, mode: str = "overwrite", path: str | None = None,
                file_format: str = "parquet") -> str:
    """Catalog table, managed or at a path."""
    writer = df.write.mode(mode).format(file_format)
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return name


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", byte_order_mark: bool = False) -> str:
    """CSV with a header, UTF-8. With ``byte_order_mark`` every file starts with one, as spreadsheets expect."""
    if byte_order_mark:
        df = df.withColumnRenamed(df.columns[0], "\ufeff" + df.columns[0])
    df.write.mode(mode).option("header", True).option("encoding", "UTF-8").csv(path)
    return path


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).json(path)
    return path


def export_results(df: DataFrame, folder: str, name: str = "results") -> tuple[str, str]:
    """The same result as JSON lines and CSV."""
    return (write_json(df, f"{folder}/{name}.json"), write_csv(df, f"{folder}/{name}.csv"))


def append_raw(df: DataFrame, raw_path: str, log_path: str, source: str, clock: datetime, run_id: str) -> int:
    """Add a load to the raw layer and one row to the run log; returns the rows written.

    A failed write is logged as an error and raised.
    """
    return _add_run(layers.stamp(df, clock, source), raw_path, log_path, "RAW", clock, run_id)


def append_processed(raw: DataFrame, processed: DataFrame, path: str, log_path: str, clock: datetime,
                     run_id: str) -> int:
    """Promote what is not processed yet, with its log row; returns the rows written."""
    return _add_run(layers.promote(raw, processed, clock), path, log_path, "PROCESSING", clock, run_id)


def append_ledger(written: DataFrame, path: str, source: str, clock: datetime, run_id: str) -> str:
    """Ledger entries of rows that were written to the raw layer."""
    entries = layers.ledger_rows(layers.with_content_hash(written), source, clock)
    return write_parquet(entries, f"{path}/run_id={run_id}")


def insert_or_ignore(batch: DataFrame, target: DataFrame, path: str, key: str, order: list, run_id: str) -> str:
    """Add the rows whose key is new; the first row of a key wins.

    The rows go to the run's own folder, so a repeated run replaces them;
    ``target`` should leave out the rows of this run.
    """
    return write_parquet(layers.insert_or_ignore(batch, target, key, order), f"{path.rstrip('/')}/run_id={run_id}")


def replace_snapshot(df: DataFrame, path: str) -> str:
    """A small table that is replaced as a whole: a new version folder, valid once Spark has marked it as written.

    A writer that stops half-way leaves the version before. That one is kept
    for readers which are at it; older ones go.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    versions = folders(spark, path, "version")
    new = f"{path}/version={int(versions[-1]) + 1 if versions else 1:012d}"
    write_parquet(df.coalesce(1), new)
    for old in versions[:-1]:
        delete(spark, f"{path}/version={old}")
    return new


def write_by_day(df: DataFrame, path: str, time: str, unit: str = "day") -> str:
    """Rows in one folder for each day of ``time`` (or the first day of its month, year, ...).

    The folders that come are replaced, the others stay as they are.
    """
    df.withColumn("day", F.to_date(F.date_trunc(unit, time))).repartition("day").write.mode("overwrite").partitionBy("day") \
        .option("partitionOverwriteMode", "dynamic").parquet(path)
    return path


def drop_days(spark: SparkSession, path: str, before: date) -> list[str]:
    """Delete the folders of days before a date; nothing else is read or written. Rows without a day stay."""
    old = [d for d in folders(spark, path, "day", complete=False) if d[:1].isdigit() and date.fromisoformat(d) < before]
    for day in old:
        delete(spark, f"{path.rstrip('/')}/day={day}")
    return old


def write_sketch(rows: DataFrame, path: str, run_id: str) -> str:
    """The sketch row of a load; repeating the load replaces it."""
    return write_parquet(sketches.run_sketch(rows), f"{path.rstrip('/')}/run_id={run_id}")


def brought(df: DataFrame, most: int = 10_000) -> list[Row]:
    """A small result as rows on the driver; more than ``most`` rows are an error, not a full driver."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows: write the result instead")
    return rows


def sync_table(df: DataFrame, path: str) -> str:
    """Copy a table to Parquet."""
    return write_parquet(df, path, "overwrite")


def _add_run(df, path, log_path, stage, clock, run_id) -> int:
    spark = df.sparkSession
    seen = Observation()
    started = datetime.now()
    try:
        write_parquet(df.observe(seen, F.count(F.lit(1)).alias("rows")), f"{path}/run_id={run_id}")
    except Exception as error:
        _log(spark, log_path, stage, "ERROR", 0, clock, str(error), started, run_id)
        raise
    rows = seen.get["rows"]
    _log(spark, log_path, stage, "SUCCESS", rows, clock, None, started, run_id)
    return rows


def _log(spark, log_path, stage, status, rows, clock, message, started, run_id):
    seconds = (datetime.now() - started).total_seconds()
    row = spark.createDataFrame([(stage, status, rows, clock, message, seconds, run_id)], ETL_LOG)
    write_parquet(row.coalesce(1), log_path, "append")
