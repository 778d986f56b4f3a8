"""Positions in a total order, computed without putting a group into one task.

``row_number()`` over a partition sends each group to a single task. Here the
rows are range-partitioned on the full order instead: a large group spans many
partitions, each task numbers its own slice, and a small table of slice sizes
(one row per partition and group) supplies the offsets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenderlake.session import durable

_PART, _SLOT = "__part", "__slot"


def row_number_by(df: DataFrame, keys: list[str], order: list[Column | str], name: str = "rank") -> DataFrame:
    """Add ``row_number()`` per key group in the given order.

    The order should be total (end it with a unique column) for a repeatable
    result. Without keys the rows get one global numbering.
    """
    sort = [F.col(k).asc_nulls_first() for k in keys] + [F.col(o) if isinstance(o, str) else o for o in order]
    placed = durable(
        df.repartitionByRange(*sort)
        .sortWithinPartitions(*sort)
        .withColumn(_PART, F.spark_partition_id())
        .withColumn(_SLOT, F.monotonically_increasing_id()))
    slices = durable(placed.groupBy(*keys, _PART).agg(F.count(F.lit(1)).alias("__n"), F.min(_SLOT).alias("__first")))
    # One row per (group, partition): the window never sees the data rows.
    before = Window.partitionBy(*keys).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select(
        *[F.col(k).alias(f"__key_{i}") for i, k in enumerate(keys)],
        F.col(_PART).alias("__offset_part"),
        (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first") + F.lit(1)).alias("__shift"))
    if slices.isEmpty():
        return df.withColumn(name, F.lit(0).cast("bigint"))
    same = F.col(_PART) == F.col("__offset_part")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__key_{i}"))
    joined = placed.join(offsets, same)
    return joined.select(*df.columns, (F.col(_SLOT) + F.col("__shift")).alias(name))


def rank_by_value(df: DataFrame, group: str = "category", value: str = "sum_value", tie: str = "id") -> DataFrame:
    """Number the rows of each group by descending value; column ``rank``."""
    return row_number_by(df, [group], [F.desc(value), F.asc(tie)], "rank")


def label_codes(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-NULL labels with alphabetical codes from 0: (label, code)."""
    labels = df.where(F.col(column).isNotNull()).select(F.col(column).alias("label")).distinct()
    return row_number_by(labels, [], [F.asc("label")], "code").withColumn("code", F.col("code") - F.lit(1))


def label_encode(df: DataFrame, columns: list[str], suffix: str = "_code") -> DataFrame:
    """Add an alphabetical integer code per column; NULL stays NULL."""
    for column in columns:
        codes = label_codes(df, column).select(F.col("label").alias("__label"), F.col("code").alias(column + suffix))
        df = df.join(codes, F.col(column) == F.col("__label"), "left").drop("__label")
    return df


def code_tables(df: DataFrame, columns: list[str], by_frequency: bool = False) -> dict[str, DataFrame]:
    """For each column its non-NULL labels with codes from 0, as a table (label, code): alphabetical, or most frequent first.

    The labels of all columns are gathered in one pass and ranked together, so
    that no column costs jobs of its own. Labels as many as rows are fine.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("of"), F.col(c).cast("string").alias("label")) for c in columns])
    labels = df.select(F.explode(pairs).alias("p")).where("p.label IS NOT NULL").groupBy("p.of", "p.label").agg(
        F.count(F.lit(1)).alias("n"))
    order = [F.desc("n"), F.asc("label")] if by_frequency else [F.asc("label")]
    ranked = durable(row_number_by(labels, ["of"], order, "code").select("of", "label", (F.col("code") - 1).alias("code")))
    return {c: ranked.where(F.col("of") == c).select("label", "code") for c in columns}
