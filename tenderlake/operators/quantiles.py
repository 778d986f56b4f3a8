"""Exact interpolated quantiles by repeated bracketing.

The built-in exact percentile gathers every distinct value in one buffer. Here
a mergeable KLL sketch brackets each wanted rank between two values; one pass
counts what lies before, at and between them, and sketches what lies between.
A bracket keeps under a hundredth of its rows, so a few passes leave a bounded
number of values, which alone are put in order. No pass shuffles values; a
value with most of the rows is found as the edge of a bracket.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

#: Size of a sketch, the quantiles read from it, and how far a bracket reaches beyond a rank, as a share of the rows:
#: some three times the error of the sketch. A bracket that misses its rank costs one more pass.
SKETCH, CUTS, MARGIN = 4096, 1000, 0.002
#: Values put in order at the end, for each rank.
FEW = 20_000


@dataclass(frozen=True)
class Bracket:
    """The values between ``low`` and ``high``, both left out (None: no bound), of which one has the wanted rank."""

    low: float | None
    high: float | None
    below: int
    inside: int
    cuts: list[float] | None

    def edges(self, rank: int) -> tuple[float | None, float | None]:
        """Two values, one on either side of the rank."""
        if self.cuts is None:
            return None, None
        at = (rank - self.below) / max(1, self.inside - 1)
        i, j = math.floor((at - MARGIN) * CUTS), math.ceil((at + MARGIN) * CUTS)
        return (self.cuts[i] if i >= 0 else None), (self.cuts[j] if j <= CUTS else None)


def _between(low: float | None, high: float | None):
    v, inside = F.col("v"), F.lit(True)
    inside = inside if low is None else inside & (v > F.lit(low))
    return inside if high is None else inside & (v < F.lit(high))


def _cuts(inside):
    sketch = F.kll_sketch_agg_double(F.when(inside, F.col("v")), F.lit(SKETCH))
    # A sketch of nothing has no quantiles.
    grid = F.expr(f"array({', '.join(f'{k / CUTS}D' for k in range(CUTS + 1))})")
    return F.when(F.count_if(inside) > 0, F.kll_sketch_get_quantile_double(sketch, grid))


def _narrowed(values: DataFrame, open_: dict[int, Bracket]) -> dict[int, Bracket | float]:
    """For each rank a narrower bracket, or its value; one pass over the values for all of them."""
    asked = sorted({(b.low, b.high, *b.edges(rank)) for rank, b in open_.items()}, key=str)
    columns = []
    for low, high, left, right in asked:
        first, last = low if left is None else left, high if right is None else right
        v, inner = F.col("v"), _between(first, last)
        before = F.lit(False) if left is None else _between(low, left)
        at_left = F.lit(False) if left is None else v == F.lit(left)
        at_right = F.lit(False) if right is None or right == left else v == F.lit(right)
        columns.append(F.struct(F.count_if(before).alias("before"), F.count_if(at_left).alias("left"),
                                F.count_if(inner).alias("inner"), F.count_if(at_right).alias("right"), _cuts(inner).alias("cuts")))
    told = dict(zip(asked, values.agg(F.array(*columns).alias("all")).first()["all"]))
    out: dict[int, Bracket | float] = {}
    for rank, b in open_.items():
        left, right = b.edges(rank)
        counts: Row = told[b.low, b.high, left, right]
        at = rank - b.below
        if at < counts["before"]:
            out[rank] = replace(b, high=left, inside=counts["before"], cuts=None)
        elif (at := at - counts["before"]) < counts["left"]:
            out[rank] = left
        elif (at := at - counts["left"]) < counts["inner"]:
            out[rank] = Bracket(b.low if left is None else left, b.high if right is None else right, rank - at, counts["inner"], counts["cuts"])
        elif (at := at - counts["inner"]) < counts["right"]:
            out[rank] = right
        else:
            at -= counts["right"]
            out[rank] = Bracket(right, b.high, rank - at, b.inside - (rank - at - b.below), None)
    return out


def _ordered(values: DataFrame, open_: dict[int, Bracket]) -> dict[int, float]:
    """Values of the ranks whose brackets hold few rows."""
    inside = [F.struct(F.lit(rank).cast("long").alias("rank"), F.lit(rank - b.below).cast("long").alias("at"),
                       _between(b.low, b.high).alias("inside")) for rank, b in open_.items()]
    own = values.select("v", F.explode(F.filter(F.array(*inside), lambda b: b["inside"])).alias("b"))
    counted = own.groupBy(F.col("b.rank").alias("rank"), F.col("b.at").alias("at"), "v").agg(F.count(F.lit(1)).alias("c"))
    # At most FEW rows for each rank.
    upto = Window.partitionBy("rank").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    reached = counted.withColumn("reached", F.sum("c").over(upto)).where(F.col("reached") > F.col("at"))
    return {r["rank"]: r["v"] for r in reached.groupBy("rank").agg(F.min("v").alias("v")).collect()}


def ranked_values(values: DataFrame, ranks: set[int], total: int, cuts: list[float] | None) -> dict[int, float]:
    """The values (column ``v``, not null, no NaN) of some ranks, counted from 0 in ascending order."""
    found: dict[int, float] = {}
    open_ = {rank: Bracket(None, None, 0, total, cuts) for rank in ranks}
    while large := {rank: b for rank, b in open_.items() if b.inside > FEW}:
        for rank, b in _narrowed(values, large).items():
            if isinstance(b, Bracket):
                open_[rank] = b
            else:
                found[rank] = b
                del open_[rank]
    return found | (_ordered(values, open_) if open_ else {})


def exact_quantiles(df: DataFrame, column: str, probabilities: list[float]) -> DataFrame:
    """Rows (probability, value): linear interpolation between closest ranks.

    NULLs are ignored, NaN is greater than any other value; an input without
    values gives no rows. The column is read a few times, whatever its size.
    """
    spark = df.sparkSession
    every = df.select(F.col(column).cast("double").alias("v")).where("v IS NOT NULL")
    values = every.where(~F.isnan("v"))
    total, nan, cuts = every.agg(F.count(F.lit(1)), F.count_if(F.isnan("v")), _cuts(~F.isnan("v"))).first()
    if not total:
        return spark.range(0).select(F.lit(0.0).alias("probability"), F.lit(0.0).alias("value"))
    places = {float(p): p * (total - 1) for p in probabilities}
    ranks = {r for at in places.values() for r in (math.floor(at), math.ceil(at))}
    found = ranked_values(values, {r for r in ranks if r < total - nan}, total - nan, cuts)
    rows = []
    for p, at in places.items():
        low, high = (found.get(r, math.nan) for r in (math.floor(at), math.ceil(at)))
        rows.append(F.struct(F.lit(p).alias("probability"), F.lit(low if low == high else low + (high - low) * (at - math.floor(at))).alias("value")))
    return spark.range(1).select(F.explode(F.array(*rows)).alias("q")).select("q.probability", "q.value")


def approximate_quantiles(df: DataFrame, column: str, probabilities: list[float], accuracy: int = 10_000) -> DataFrame:
    """Same rows from the mergeable sketch: one pass, error at most 1/accuracy."""
    sketch = df.agg(F.percentile_approx(column, [float(p) for p in probabilities], accuracy).alias("q"))
    probs = F.array(*[F.lit(float(p)) for p in probabilities])
    return (sketch.where(F.col("q").isNotNull())
            .select(F.explode(F.arrays_zip(probs.alias("probability"), F.col("q").alias("value"))).alias("z"))
            .select(F.col("z.probability").alias("probability"), F.col("z.value").cast("double").alias("value")))


def median(df: DataFrame, column: str) -> DataFrame:
    return exact_quantiles(df, column, [0.5]).select(F.col("value").alias("median"))


def describe_numeric(df: DataFrame, column: str) -> DataFrame:
    """One row: count, mean, std (sample), min, quartiles, max of a column."""
    quartiles = exact_quantiles(df, column, [0.25, 0.5, 0.75])
    row = quartiles.agg(F.struct(*[
        F.max(F.when(F.col("probability") == p, F.col("value"))).alias(name)
        for p, name in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))]).alias("q"))
    basic = df.agg(F.count(column).alias("count"), F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"),
                   F.min(column).alias("min"), F.max(column).alias("max"))
    return (basic.withColumn("q", row.scalar())
            .select("count", "mean", "std", "min", "q.q25", "q.q50", "q.q75", "max"))
