"""Scaling-law fits and throughput tables as grouped aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Acceptance limits of the two linearity tests.
LINEAR_R2 = 0.95
LINEAR_SLOPE = 1.2
ACCEPTABLE_SLOPE = 2.0


def origin_fit(df: DataFrame, x: str, y: str, groups: list[str] | None = None) -> DataFrame:
    """``y = a x``: coefficient, R2 and whether it counts as linear.

    One pass: the residual sum follows from the moments.
    """
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    both = df.where(a.isNotNull() & b.isNotNull())
    sums = both.groupBy(*(groups or [])).agg(
        F.sum(a * b).alias("xy"), F.sum(a * a).alias("xx"), F.sum(b * b).alias("yy"),
        (F.var_pop(b) * F.count(F.lit(1))).alias("spread"))
    residual = F.col("yy") - F.try_divide(F.col("xy") * F.col("xy"), F.col("xx"))
    r2 = F.when(F.col("spread") > 0, F.lit(1.0) - residual / F.col("spread")).otherwise(F.lit(0.0))
    return sums.select(*(groups or []), F.try_divide("xy", "xx").alias("coefficient"), r2.alias("r_squared"),
                       (r2 > F.lit(LINEAR_R2)).alias("is_linear"))


def power_fit(df: DataFrame, x: str, y: str, groups: list[str] | None = None) -> DataFrame:
    """``ln y = slope ln x + intercept`` over positive pairs, with the complexity class."""
    positive = df.where((F.col(x) > 0) & (F.col(y) > 0))
    lx, ly = F.log(F.col(x).cast("double")), F.log(F.col(y).cast("double"))
    fit = positive.groupBy(*(groups or [])).agg(
        F.regr_slope(ly, lx).alias("slope"), F.regr_intercept(ly, lx).alias("intercept"),
        F.regr_r2(ly, lx).alias("r_squared"))
    kind = (F.when(F.col("slope") < LINEAR_SLOPE, F.lit("linear"))
            .when(F.col("slope") < ACCEPTABLE_SLOPE, F.lit("acceptable"))
            .when(F.col("slope").isNotNull(), F.lit("needs optimisation")))
    return fit.withColumn("complexity", kind)


def throughput(df: DataFrame, size: str, seconds: str) -> DataFrame:
    """Add rows per second and seconds per million rows to a run table."""
    return df.withColumns({
        "rows_per_second": F.coalesce(F.try_divide(F.col(size).cast("double"), F.col(seconds)), F.lit(0.0)),
        "seconds_per_million": F.coalesce(F.try_divide(F.col(seconds) * 1_000_000, F.col(size).cast("double")), F.lit(0.0)),
    })


def spread(df: DataFrame, column: str) -> DataFrame:
    """Largest, smallest and mean value and the ratio of the extremes."""
    return df.agg(F.max(column).alias("max"), F.min(column).alias("min"), F.avg(column).alias("mean"),
                  F.try_divide(F.max(column), F.min(column)).alias("max_to_min"))
