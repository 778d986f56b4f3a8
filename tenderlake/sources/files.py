"""File readers. With a schema a read costs no extra pass over the files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenderlake.operators.cleaning import cast_by_role
from tenderlake.schema import REQUIRED_UPLOAD_COLUMNS


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             header: bool = True, **options) -> DataFrame:
    """CSV, UTF-8. Types are inferred (one extra pass) only without a schema."""
    reader = spark.read.option("header", header).option("encoding", "UTF-8").options(**options)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON lines."""
    return (spark.read.schema(schema) if schema else spark.read).json(path)


def read_any(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Reader by file extension; an unknown extension is an error."""
    name = path.rstrip("/").lower()
    if name.endswith(".csv"):
        return read_csv(spark, path, schema)
    if name.endswith(".parquet"):
        return read_parquet(spark, path)
    if name.endswith(".json"):
        return read_json(spark, path, schema)
    raise ValueError(f"unsupported file format: {path}")


def read_upload(spark: SparkSession, path: str, required: list[str] = REQUIRED_UPLOAD_COLUMNS) -> DataFrame:
    """A user's CSV, with or without a byte-order mark; required columns are checked.

    Everything is read as text, in one pass, and cast by role: budgets become
    numbers and dates timestamps, numbers that are names keep their zeros.
    """
    df = spark.read.option("header", True).option("encoding", "UTF-8").csv(path)
    df = df.toDF(*[c.lstrip("﻿").strip() for c in df.columns])
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return cast_by_role(df)


def read_layer(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored layer, or an empty frame of its schema when nothing is stored yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        # Known to be empty when a query is planned, so joins with it fall away.
        return spark.range(0).where(F.lit(False)).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a text log, column ``value``."""
    return spark.read.text(path)


def union_feeds(*feeds: DataFrame) -> DataFrame:
    """Several feeds as one frame; absent columns become NULL."""
    first, *others = feeds
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
