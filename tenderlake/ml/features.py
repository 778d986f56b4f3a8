"""Feature preparation as DataFrame operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenderlake.functions import numbers
from tenderlake.operators.ranking import label_codes

CATEGORICAL = ["category", "region", "organization", "status", "procurement_type"]
NUMERICAL = ["quantity", "unit_price", "supplier_rating", "contract_duration_days",
             "competitive_level", "advance_payment_pct"]
LABEL = "total_cost"
SEED = 42
TRAIN_SHARE = 0.8


def standardise(df: DataFrame, columns: list[str], suffix: str = "_std") -> DataFrame:
    """(x - mean) / population deviation; a constant column becomes 0."""
    moments = df.agg(F.struct(*[
        F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("dev")).alias(c) for c in columns]).alias("m")).scalar()

    def scaled(c: str) -> Column:
        shift = F.col(c) - F.col(f"__m.{c}.mean")
        return F.when(F.col(f"__m.{c}.dev") == 0, shift * 0.0).otherwise(shift / F.col(f"__m.{c}.dev"))

    return df.withColumn("__m", moments).withColumns({c + suffix: scaled(c) for c in columns}).drop("__m")


def dummy_codes(df: DataFrame, train: DataFrame, column: str) -> DataFrame:
    """Add ``<column>_code``: dummies in sparse form, for any number of values.

    The code is the place of the one among the training values in alphabetical
    order; an unseen or missing value has none.
    """
    codes = label_codes(train, column).select(F.col("label").alias("__label"), F.col("code").alias(f"{column}_code"))
    return df.join(codes, F.col(column) == F.col("__label"), "left").drop("__label")


def one_hot(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """0/1 columns for a given list of values; any other value is all zeros."""
    return df.withColumns({
        f"{column}_{v}": F.coalesce((F.col(column) == F.lit(v)).cast("int"), F.lit(0)) for v in values})


def hash_split(df: DataFrame, key: str, share: float = TRAIN_SHARE, seed: int = SEED) -> DataFrame:
    """Add ``is_train``, fixed by the key: independent of partitioning and retries."""
    return df.withColumn("is_train", numbers.stable_uniform(key, seed) < F.lit(share))


def forecast_frame(df: DataFrame, days: int = 30, time: str = "published_at") -> DataFrame:
    """Future rows: the first ``days`` rows, repeated until the horizon is covered,
    dated one day after the last date and onwards."""
    last = df.agg(F.max(time).alias("t")).scalar()
    head = df.orderBy(time, "id").limit(days).select("id", "category", "region", "status", time)
    # At most ``days`` rows from here on.
    order = Window.partitionBy(F.lit(0)).orderBy(time, "id")
    whole = Window.partitionBy(F.lit(0))
    placed = head.select("category", "region", "status", F.row_number().over(order).alias("pos"),
                         F.count(F.lit(1)).over(whole).alias("n"))
    repeated = placed.withColumn("day", F.explode(F.sequence(F.col("pos"), F.lit(days), F.col("n").cast("int")))) \
        .where(F.col("day") <= days)
    return repeated.select("day", "category", "region", "status",
                           F.date_add(F.to_date(last), F.col("day")).alias("forecast_on"))
