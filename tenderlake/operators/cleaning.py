"""Cleaning rules: missing values, types, derived columns, validity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderlake.functions import dates, numbers


def drop_missing(df: DataFrame) -> DataFrame:
    """Drop rows with a NULL in any column."""
    return df.na.drop()


def fill_with_mean(df: DataFrame) -> DataFrame:
    """Replace NULLs of integer and double columns by the column mean.

    The means are one scalar sub-query; an integer column takes the truncated
    mean, a column without any value stays NULL.
    """
    names = [c for c, kind in df.dtypes if "int" in kind or kind == "double"]
    if not names:
        return df
    means = df.agg(F.struct(*[F.avg(c).alias(c) for c in names]).alias("means")).scalar()
    kinds = dict(df.dtypes)
    filled = df.withColumn("__means", means)
    return filled.select(*[
        F.coalesce(F.col(c), F.col(f"__means.{c}").cast(kinds[c])).alias(c) if c in names else F.col(c)
        for c in df.columns])


def handle_missing(df: DataFrame, strategy: str = "drop") -> DataFrame:
    """``drop`` rows with NULLs, fill with the ``mean``, or leave as is."""
    if strategy == "drop":
        return drop_missing(df)
    if strategy == "mean":
        return fill_with_mean(df)
    return df


def keep_valid(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows that meet every rule."""
    return df.filter(reduce(lambda a, b: a & b, rules.values())) if rules else df


def quarantine(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows that miss a rule, with the name of the first one missed."""
    if not rules:
        return df.withColumn("failed_rule", F.lit(None).cast("string")).limit(0)
    failed = F.coalesce(*[F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()])
    return df.withColumn("failed_rule", failed).where(F.col("failed_rule").isNotNull())


def cast_by_role(df: DataFrame, numeric: list[str] | None = None, temporal: list[str] | None = None) -> DataFrame:
    """Make columns numeric or temporal by role.

    Without explicit lists the names decide: ``budget`` or ``sum`` -> double,
    otherwise ``date`` -> timestamp.
    """
    if numeric is None:
        numeric = [c for c in df.columns if "budget" in c.lower() or "sum" in c.lower()]
    if temporal is None:
        temporal = [c for c in df.columns if "date" in c.lower() and c not in numeric]
    changes = {c: numbers.as_double(c) for c in numeric}
    changes.update({c: dates.as_timestamp(c) for c in temporal})
    return df.withColumns(changes) if changes else df


def normalise_number_text(df: DataFrame) -> DataFrame:
    """In every text column, write numbers in double form and keep other text."""
    texts = [c for c, kind in df.dtypes if kind == "string"]
    return df.withColumns({c: numbers.number_text(c) for c in texts}) if texts else df


def promote_numeric_text(df: DataFrame) -> DataFrame:
    """Turn a text column into doubles when all its non-NULL values are numbers.

    One pass over the text columns decides for all of them.
    """
    texts = [c for c, kind in df.dtypes if kind == "string"]
    if not texts:
        return df
    checks = df.agg(*[
        ((F.count(c) > 0) & (F.count(c) == F.count(numbers.as_double(c)))).alias(c) for c in texts]).first()
    promoted = {c: numbers.as_double(c) for c in texts if checks[c]}
    return df.withColumns(promoted) if promoted else df


def add_unit_price(df: DataFrame, total: str = "sum_value", quantity: str = "quantity") -> DataFrame:
    return df.withColumn("unit_price", numbers.unit_price(total, quantity))


def add_date_parts(df: DataFrame, column: str = "date") -> DataFrame:
    """Year, month and day; unparsable text gives NULLs."""
    kind = dict(df.dtypes)[column]
    parsed = dates.as_timestamp(column) if kind == "string" else F.col(column)
    return df.select("*", *dates.date_parts(parsed))
