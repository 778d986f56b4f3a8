"""Scaling study: the same clean-and-aggregate job over growing inputs."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.operators import aggregates, cleaning, dedup, regression

RESULT = ("records bigint, gen_seconds double, clean_seconds double, agg_seconds double, "
          "total_seconds double")


def run(spark: SparkSession, sizes: Iterable[int], make: Callable[[int], DataFrame]) -> DataFrame:
    """Time generation, cleaning and aggregation per size; one row per size.

    ``make(size)`` supplies the input. Each stage runs into the no-op sink.
    """
    rows = []
    for size in sizes:
        tenders = make(size)
        clean = dedup.distinct_rows(cleaning.drop_missing(tenders))
        gen = _seconds(tenders)
        cleaned = _seconds(clean)
        summed = _seconds(aggregates.category_summary(clean))
        rows.append((size, gen, cleaned, summed, gen + cleaned + summed))
    measured = spark.createDataFrame(rows, RESULT)
    return regression.throughput(measured, "records", "total_seconds")


def verdict(results: DataFrame) -> DataFrame:
    """Both linearity tests over a result table, one row."""
    power = regression.power_fit(results, "records", "total_seconds").select(F.struct("slope", "complexity"))
    return (regression.origin_fit(results, "records", "total_seconds").withColumn("p", power.scalar())
            .select("coefficient", "r_squared", "is_linear", "p.slope", "p.complexity"))


def _seconds(df: DataFrame) -> float:
    start = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start
