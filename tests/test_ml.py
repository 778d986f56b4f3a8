from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenderlake.ml import features, models
from tenderlake.session import scratch_path
from tenderlake.sources import synthetic


@pytest.fixture(scope="module")
def costs(spark):
    i = F.col("id")
    return spark.range(600).select(
        i, F.concat(F.lit("c"), (i % 3).cast("string")).alias("category"),
        F.concat(F.lit("r"), (i % 4).cast("string")).alias("region"),
        F.concat(F.lit("o"), (i % 20).cast("string")).alias("organization"), F.lit("open").alias("status"),
        F.lit("works").alias("procurement_type"), (i % 17 + 1).alias("quantity"),
        (i % 13 + 1).cast("double").alias("unit_price"), F.lit(1.0).alias("supplier_rating"),
        (i % 30).alias("contract_duration_days"), (i % 4 + 1).alias("competitive_level"),
        F.lit(5.0).alias("advance_payment_pct"), (3.0 * (i % 17 + 1) + 2.0 * (i % 13 + 1) + 7).alias("total_cost"))


def test_linear_model_recovers_a_linear_label(costs):
    _, metrics = models.train(costs, "linear")
    got = {r.is_train: r for r in metrics.collect()}
    assert got[True].r2 > 0.999 and got[False].r2 > 0.999
    assert got[True].size + got[False].size == 600


def test_metrics_equal_numpy(spark):
    rng = np.random.default_rng(1)
    y, p = rng.normal(size=200), rng.normal(size=200)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, prediction double")
    r = models.regression_metrics(df, "y").first()
    assert r.mse == pytest.approx(np.mean((y - p) ** 2)) and r.mae == pytest.approx(np.mean(abs(y - p)))
    assert r.r2 == pytest.approx(1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2))


def test_unseen_category_and_stored_model(spark, costs):
    model, _ = models.train(costs, "random_forest", numTrees=3, maxDepth=3)
    path = scratch_path(spark, "model")
    models.save(model, path)
    unseen = costs.limit(1).withColumn("category", F.lit("never seen"))
    assert models.load_coded(spark, path).transform(unseen).first().prediction == model.transform(unseen).first().prediction


def test_wide_categories_are_coded_like_any_other(costs):
    wide = costs.withColumn("organization", F.concat(F.lit("o"), F.col("id").cast("string")))  # every label once
    model, metrics = models.train(wide, "linear")
    assert metrics.count() == 2
    codes = [r.code for r in model.codes["organization"].orderBy("label").collect()]
    assert codes == list(range(len(codes))) and len(codes) == wide.where(F.col("id") >= 0).count() - \
        metrics.where("not is_train").first()["size"]
    unseen = model.transform(wide.limit(1).withColumn("organization", F.lit("never seen"))).first()
    assert unseen.organization_index == len(codes)


def test_dummy_codes(spark):
    df = spark.createDataFrame([("b",), ("z",), (None,), ("a",)], "s string")
    got = {r.s: r.s_code for r in features.dummy_codes(df, df.where("s < 'c'"), "s").collect()}
    assert got == {"a": 0, "b": 1, "z": None, None: None}


def test_unknown_kind():
    with pytest.raises(ValueError):
        models.regressor("crystal_ball")


def test_standardise_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 4.0), (2.0, 4.0), (6.0, 4.0)], "a double, b double")
    rows = features.standardise(df, ["a", "b"]).orderBy("a").collect()
    want = (np.array([1, 2, 6]) - 3) / np.std([1, 2, 6])
    assert [r.a_std for r in rows] == pytest.approx(list(want)) and [r.b_std for r in rows] == [0.0] * 3


def test_one_hot_of_unseen_and_null(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "s string")
    got = features.one_hot(df, "s", ["a", "b"]).collect()
    assert [(r.s_a, r.s_b) for r in got] == [(1, 0), (0, 0), (0, 0)]


@pytest.mark.parametrize("n", [3, 40])
def test_forecast_covers_every_day(spark, n):
    df = synthetic.generate_tenders(spark, n, date(2024, 12, 31)).withColumnRenamed("published_on", "published_at")
    out = models.forecast(models.train_forecast(df, trees=2, depth=2), df).orderBy("day").collect()
    assert [r.day for r in out] == list(range(1, 31))
    assert out[0].forecast_on == date(2025, 1, 1) and out[-1].forecast_on == date(2025, 1, 30)
    assert all(r.predicted_budget is not None for r in out)


def test_volume_study_samples_are_nested(costs):
    got = {(r.share, r.is_train): r["size"] for r in models.volume_study(costs, [0.3, 1.0], "linear").collect()}
    assert got[(0.3, True)] + got[(0.3, False)] < got[(1.0, True)] + got[(1.0, False)] == 600


def test_frequency_forest_rmse(costs):
    rows = costs.withColumnRenamed("total_cost", "label")
    predicted = models.frequency_forest(trees=3).fit(rows).transform(rows)
    assert models.rmse(predicted) == pytest.approx(models.regression_metrics(predicted, "label").first().rmse)


def test_metrics_are_those_of_the_stored_predictions(spark, costs):
    import duckdb

    folder = scratch_path(spark, "models")
    small = {"gradient_boosting": {"maxIter": 3}, "random_forest": {"numTrees": 3}}
    rows = costs.withColumn("total_cost", F.col("total_cost") + F.sin(F.col("id").cast("double")) * 4)
    got = {(r.model, r.is_train): r for r in models.train_all(rows, folder, overrides=small).collect()}
    assert len(got) == 6
    for (kind, split), r in got.items():
        mse, r2, mae, size = duckdb.execute(f"""SELECT avg((total_cost - prediction) ** 2), 1 - avg((total_cost - prediction) ** 2)
            / var_pop(total_cost), avg(abs(total_cost - prediction)), count(*)
            FROM '{folder}/{kind}/predictions/*.parquet' WHERE is_train = {split}""").fetchone()
        assert (r.mse, r.rmse, r.r2, r.mae, r.size) == pytest.approx((mse, mse ** 0.5, r2, mae, size))


def test_labels_of_every_row_reach_no_driver(costs):
    """A forest over a label that each row has alone: codes are a table, the fitted stages know numbers only."""
    rows = costs.withColumn("tender_no", F.concat(F.lit("t"), F.col("id"))).withColumn("label", F.col("total_cost"))
    model = models.frequency_forest(trees=2, columns=["tender_no", "category"]).fit(rows)
    assert not any("StringIndexer" in type(s).__name__ for s in model.fitted.stages)
    assert model.codes["tender_no"].count() == 600
    assert [r.label for r in model.codes["category"].orderBy("code").collect()] == ["c0", "c1", "c2"]
    unseen = model.transform(rows.limit(2).withColumn("tender_no", F.when(F.col("id") == 0, "new")))
    assert {r.tender_no_index for r in unseen.collect()} == {600.0}
    hot = models.forecast_pipeline("label", trees=2, depth=2, columns=["tender_no"]).fit(
        rows.withColumn("day_seconds", F.col("id").cast("double")))
    assert hot.transform(rows.withColumn("day_seconds", F.lit(1.0))).where("prediction IS NULL").count() == 0


def test_studies_derive_their_rows_once(spark, costs):
    made = spark.sparkContext.accumulator(0)
    rows = costs.sparkSession.createDataFrame(costs.rdd.map(lambda r: (made.add(1), r)[1]), costs.schema)
    got = {(r.share, r.is_train): r.r2 for r in models.volume_study(rows, [0.5, 1.0], "linear").collect()}
    assert made.value == 600
    assert got == {(r.share, r.is_train): r.r2 for r in models.volume_study(costs, [0.5, 1.0], "linear").collect()}
