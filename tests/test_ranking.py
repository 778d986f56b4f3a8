import numpy as np
import pytest
from pyspark.sql import functions as F

from tenderlake.operators import quantiles, ranking


def skewed(spark, n=3000):
    """One group and one value hold more than a third of all rows."""
    i = F.col("id")
    return spark.range(n).select(
        i, F.when(i % 5 < 2, "hot").when(i % 50 == 3, F.lit(None)).otherwise(F.concat(F.lit("g"), (i % 7).cast("string")))
        .alias("category"),
        F.when(i % 2 == 0, F.lit(5)).otherwise(F.pmod(i * 7919, F.lit(101))).cast("double").alias("sum_value"))


def test_rank_equals_row_number(spark):
    df = skewed(spark)
    got = {r.id: r.rank for r in ranking.rank_by_value(df).collect()}
    by_group = {}
    for r in sorted(df.collect(), key=lambda r: (-r.sum_value, r.id)):
        by_group.setdefault(r.category, []).append(r.id)
    want = {key: k + 1 for ids in by_group.values() for k, key in enumerate(ids)}
    assert got == want


def test_hot_group_spans_partitions(spark):
    df = skewed(spark).where("category = 'hot'")
    sort = [F.col("category"), F.desc("sum_value"), F.col("id")]
    parts = df.repartitionByRange(*sort).groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) > 1


def test_global_positions_and_empty_input(spark):
    df = skewed(spark, 100)
    assert sorted(r.pos for r in ranking.row_number_by(df, [], ["id"], "pos").collect()) == list(range(1, 101))
    assert ranking.row_number_by(df.limit(0), ["category"], ["id"], "pos").collect() == []


def test_label_codes_are_alphabetical(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",), ("ё",), ("Я",)], "x string")
    got = {r.x: r.x_code for r in ranking.label_encode(df, ["x"]).collect()}
    assert got == {"a": 0, "b": 1, "Я": 2, "ё": 3, None: None}


@pytest.mark.parametrize("values", [[1.0], [1.0, 2.0], [5.0] * 900 + list(range(500)), list(range(1001))])
def test_quantiles_interpolate(spark, values):
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double").repartition(8)
    got = {r.probability: r.value for r in quantiles.exact_quantiles(df, "v", probs).collect()}
    assert got == pytest.approx({p: float(np.quantile(values, p)) for p in probs})


@pytest.mark.parametrize("kind", ["heavy tail", "constant", "two values", "one of many", "infinite", "negative"])
def test_quantiles_by_brackets(spark, monkeypatch, kind):
    monkeypatch.setattr(quantiles, "FEW", 5)
    monkeypatch.setattr(quantiles, "SKETCH", 64)  # so inexact that brackets miss
    rng = np.random.default_rng(3)
    values = {"heavy tail": rng.pareto(0.3, 3000), "constant": np.full(3000, 7.25), "two values": rng.choice([1.0, 2.0], 3000),
              "one of many": np.where(rng.random(3000) < 0.7, 5.0, rng.normal(5, 1, 3000)),
              "infinite": np.where(rng.random(3000) < 0.2, np.inf, rng.normal(size=3000)), "negative": -rng.exponential(size=3000)}[kind]
    probs = [0.0, 0.001, 0.1, 0.25, 0.5, 0.75, 0.9, 0.999, 1.0]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)] * 10, "v double").repartition(6)
    got = {r.probability: r.value for r in quantiles.exact_quantiles(df, "v", probs).collect()}
    low, high = (np.quantile(values, probs, method=m) for m in ("lower", "higher"))
    share = np.mod(np.multiply(probs, len(values) - 1), 1)
    want = [float(a) if a == b else float(a + (b - a) * s) for a, b, s in zip(low, high, share)]
    assert got == pytest.approx(dict(zip(probs, want)))


def test_quantiles_put_nan_last(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (3.0,), (float("nan"),)], "v double")
    got = [r.value for r in quantiles.exact_quantiles(df, "v", [0.0, 0.5, 1.0]).orderBy("probability").collect()]
    assert got[:2] == [1.0, 3.0] and np.isnan(got[2])


def test_quantile_passes_shuffle_no_values(spark):
    df = spark.range(200_000).selectExpr("CAST(id * 7919 % 200000 AS double) AS v")
    values = df.where("v IS NOT NULL")
    plan = values.agg(quantiles._cuts(F.lit(True)))._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" in plan and "hashpartitioning" not in plan and "rangepartitioning" not in plan
    ranks = {0, 1234, 99_999, 199_999}
    assert quantiles.ranked_values(values, ranks, 200_000, values.agg(quantiles._cuts(F.lit(True))).first()[0]) == {r: float(r) for r in ranks}


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert quantiles.exact_quantiles(df, "v", [0.5]).collect() == []
    row = quantiles.describe_numeric(df, "v").first()
    assert (row["count"], row.q50) == (0, None)


def test_approximate_quantiles(spark):
    df = spark.range(1, 1001).select(F.col("id").cast("double").alias("v"))
    got = {r.probability: r.value for r in quantiles.approximate_quantiles(df, "v", [0.25, 0.5]).collect()}
    assert got == {0.25: 250.0, 0.5: 500.0}
