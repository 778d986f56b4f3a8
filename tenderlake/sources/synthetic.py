"""Synthetic tenders for scaling runs, generated where they are used."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.functions import numbers, text

# The domains the scaling runs cycle through.
CATEGORIES = ["Медицина", "Транспорт", "Строительство", "Энергетика",
              "IT", "Образование", "Жилье", "Благоустройство"]
REGIONS = ["Москва", "СПб", "Екатеринбург", "Новосибирск", "Казань", "Краснодар"]
STATUSES = ["Объявлена", "Закрыта", "В работе", "Отменена"]
ORGANIZATIONS = 100
DESCRIPTIONS = 10
LOG_MEAN, LOG_SIGMA = 10.0, 2.0
DAYS = 365


def tenders_of(ids: DataFrame, key: str, anchor: Column | date, seed: int = 42) -> DataFrame:
    """One tender per id. Every value is a function of the id, so a lost
    partition is regenerated identically."""
    k = F.col(key)
    anchor = anchor if isinstance(anchor, Column) else F.lit(anchor)

    def cycle(values):
        return F.element_at(F.array(*[F.lit(v) for v in values]), (k % len(values) + 1).cast("int"))

    return ids.select(
        k.cast("bigint").alias("id"),
        text.padded_number(k).alias("tender_no"),
        F.concat(F.lit("Org_"), (k % ORGANIZATIONS).cast("string")).alias("organization"),
        F.concat(F.lit("Закупка тип "), (k % DESCRIPTIONS).cast("string")).alias("description"),
        cycle(CATEGORIES).alias("category"),
        cycle(REGIONS).alias("region"),
        F.exp(F.lit(LOG_MEAN) + F.lit(LOG_SIGMA) * numbers.stable_normal(key, seed)).alias("budget"),
        cycle(STATUSES).alias("status"),
        F.date_sub(anchor, (k % DAYS).cast("int")).alias("published_on"))


def generate_tenders(spark: SparkSession, rows: int, anchor: Column | date, seed: int = 42,
                     partitions: int | None = None) -> DataFrame:
    """``rows`` tenders spread over the cluster."""
    return tenders_of(spark.range(0, rows, 1, partitions), "id", anchor, seed)
