"""Batch ETL: extract, clean, derive, aggregate, store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake import sinks
from tenderlake.operators import aggregates, cleaning, dedup
from tenderlake.sources import files


def transform(df: DataFrame, key: str = "id", order: list | None = None) -> DataFrame:
    """De-duplicate on the key, drop incomplete rows, normalise number text,
    add the unit price and date parts where their inputs exist."""
    df = dedup.keep_first(df, [key], order or [c for c in df.columns if c != key])
    df = cleaning.normalise_number_text(cleaning.drop_missing(df))
    if {"sum_value", "quantity"} <= set(df.columns):
        df = cleaning.add_unit_price(df)
    if "date" in df.columns:
        df = cleaning.add_date_parts(df)
    return df


def clean(df: DataFrame, numeric: list[str] | None = None, temporal: list[str] | None = None) -> DataFrame:
    """Drop incomplete rows, drop copies, cast by role."""
    return cleaning.cast_by_role(dedup.distinct_rows(cleaning.drop_missing(df)), numeric, temporal)


def run(spark: SparkSession, source_path: str, lake: str, run_id: str, table: str | None = None,
        schema=None) -> dict[str, str]:
    """The whole job; returns where things were stored.

    The aggregate reads the stored layer, so the cleaning runs once.
    """
    detail = sinks.write_lake_layer(transform(files.read_any(spark, source_path, schema)), lake, "processed", run_id)
    summary = aggregates.by_dimensions(files.read_parquet(spark, detail))
    stored = {"processed": detail, "aggregated": sinks.write_lake_layer(summary, lake, "aggregated", run_id)}
    if table:
        stored["table"] = sinks.write_table(files.read_parquet(spark, stored["aggregated"]), table)
    return stored


def as_etl_frame(tenders: DataFrame) -> DataFrame:
    """The ETL record (id, tender_name, ..., sum_value, quantity, date) of a tender table."""
    return tenders.select(
        "id", F.col("tender_no").alias("tender_name"), "category", "region",
        F.floor("budget").cast("bigint").alias("sum_value"), (F.col("id") % 7).cast("int").alias("quantity"),
        F.to_date("published_at").cast("string").alias("date"), "organization", "status")
