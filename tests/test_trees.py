"""Trees learned from binned rows against those of Spark's own trainers."""

import threading

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from tenderlake.ml import models, trees
from tenderlake.session import scratch_folder, scratch_tables

NAMES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def points(spark):
    i = F.col("id")
    rows = spark.range(0, 3000, 1, 3).select(
        i, (i % 7).cast("double").alias("a"), F.sin(i.cast("double")).alias("b"), F.lit(2.0).alias("c"),
        (i * i % 11).cast("double").alias("d"))
    rows = rows.withColumn("label", F.col("a") * F.col("b") * 3 + F.col("d") + F.cos(i.cast("double")))
    return VectorAssembler(inputCols=NAMES, outputCol="features").transform(rows).persist()


def _predicted(model, rows):
    return np.array([r.prediction for r in model.transform(rows).orderBy("id").select("prediction").collect()])


def _splits(model):
    return [line for line in model.toDebugString.split("\n")[1:] if "Predict" not in line]


@pytest.mark.parametrize("mine, theirs, how", [
    (trees.BoostedTrees, GBTRegressor, {"maxIter": 4, "maxDepth": 3, "stepSize": 0.1}),
    (trees.BoostedTrees, GBTRegressor, {"maxIter": 2, "maxDepth": 1, "maxBins": 8, "minInstancesPerNode": 400}),
    (trees.BaggedTrees, RandomForestRegressor,
     {"numTrees": 2, "maxDepth": 6, "bootstrap": False, "featureSubsetStrategy": "all", "minInfoGain": 0.01})])
def test_trees_are_those_of_spark(points, mine, theirs, how):
    got, want = mine(**how, seed=1).fit(points), theirs(**how, seed=1).fit(points)
    assert _splits(got) == _splits(want) and got.totalNumNodes == want.totalNumNodes
    assert _predicted(got, points) == pytest.approx(_predicted(want, points), rel=1e-9, abs=1e-9)
    assert got.featureImportances.toArray() == pytest.approx(want.featureImportances.toArray())
    assert got.getMaxDepth() == how["maxDepth"] and got.treeWeights == want.treeWeights


def test_bootstrapped_forest(points, monkeypatch):
    # Blocks of few rows, and tables by code as well as by single bins.
    monkeypatch.setattr(trees, "BLOCK", 700)
    got = trees.BaggedTrees(numTrees=12, maxDepth=6, featureSubsetStrategy="all", seed=1).fit(points)
    want = RandomForestRegressor(numTrees=12, maxDepth=6, featureSubsetStrategy="all", seed=1).fit(points)
    y = np.array([r.label for r in points.orderBy("id").select("label").collect()])
    errors = [np.mean((_predicted(m, points) - y) ** 2) / y.var() for m in (got, want)]
    assert errors[0] == pytest.approx(errors[1], rel=0.3) and errors[0] < 0.05
    assert len({t.toDebugString.split("\n", 1)[1] for t in got.trees}) == 12
    counts = trees.poisson_counts(1.0)
    assert counts.mean() == pytest.approx(1, abs=1e-3) and counts.var() == pytest.approx(1, abs=1e-2)


def test_counts_by_code_and_by_bin_are_equal():
    draw = np.random.default_rng(3)
    bins = trees.Bins([np.arange(n - 1) + 0.5 for n in (3, 32, 1, 32, 5, 32)])
    codes = bins.codes(np.stack([draw.integers(0, n, 5000) for n in bins.sizes], 1).astype(float))
    node, y, weight = draw.integers(0, 4, 5000), draw.normal(size=5000), draw.integers(1, 4, 5000).astype(float)
    by_code, by_bin = (trees.Counter(bins, 4, coded) for coded in (True, False))
    for counter in (by_code, by_bin):
        counter.add(codes, node, y, weight)
    assert by_code.result() == pytest.approx(by_bin.result())
    assert by_code.result()[:, :3, 0].sum() == weight.sum()


def test_rows_of_one_file_are_dealt_to_all_cores(points, spark):
    with scratch_tables(spark):
        vectors = spark.range(0, 100_000, 1, 1).select(array_to_vector(F.array((F.col("id") % 50).cast("double"))).alias("features"),
                                                       F.col("id").cast("double").alias("label"))
        rows = trees.binned(vectors, "features", "label", 32, 1)
        assert len(rows.tasks) == spark.sparkContext.defaultParallelism
        sizes = [sum(n for *_, n in t) for t in rows.tasks]
        assert sum(sizes) == 100_000 and max(sizes) < 1.5 * min(sizes)


def test_constant_rows_and_missing_labels(points):
    flat = trees.BoostedTrees(maxIter=2, maxDepth=2).fit(points.withColumn("label", F.lit(4.0)))
    assert set(_predicted(flat, points)) == {4.0} and flat.totalNumNodes == 2
    with pytest.raises(Exception, match="labels must be numbers"):
        trees.BaggedTrees(numTrees=1, featureSubsetStrategy="all").fit(
            points.withColumn("label", F.when(F.col("id") > 5, F.col("label"))))
    with pytest.raises(ValueError, match="no rows"):
        trees.BoostedTrees(maxIter=1).fit(points.where("id < 0"))


def test_what_is_not_learned_here_is_left_to_spark(points, monkeypatch):
    monkeypatch.setattr(trees, "MOST_FEATURES", 3)
    assert trees.BoostedTrees(maxIter=1, maxDepth=2).fit(points).totalNumNodes > 1
    monkeypatch.setattr(trees, "binned", None)
    heavy = points.withColumn("weight", F.lit(2.0))
    model = trees.BoostedTrees(maxIter=1, maxDepth=2, weightCol="weight").fit(heavy)
    assert model.totalNumNodes > 1
    assert trees.BaggedTrees(numTrees=2, maxDepth=2, featureSubsetStrategy="onethird").fit(points).getNumTrees == 2


def test_cost_models_learn_from_binned_rows():
    assert isinstance(models.regressor("gradient_boosting"), trees.BoostedTrees)
    assert isinstance(models.regressor("random_forest"), trees.BaggedTrees)


def test_kinds_share_their_coded_rows_and_shares_fit_side_by_side(spark, tmp_path, monkeypatch):
    i = F.col("id")
    rows = spark.range(300).select(i, *[F.concat(F.lit(c), i % 3).alias(c) for c in models.prep.CATEGORICAL],
                                   *[(i * k % 17).cast("double").alias(c) for k, c in enumerate(models.prep.NUMERICAL, 2)],
                                   (i % 17 + i % 3).cast("double").alias("total_cost"))
    calls, code_tables = [], models.code_tables
    monkeypatch.setattr(models, "code_tables", lambda *a: calls.append(1) or code_tables(*a))
    small = {"gradient_boosting": {"maxIter": 1}, "random_forest": {"numTrees": 1, "maxDepth": 2}}
    assert models.train_all(rows, str(tmp_path), overrides=small).count() == 6
    assert len(calls) == 1

    # Each of the two fits waits for the other.
    both, train = threading.Barrier(2, timeout=60), models.train
    monkeypatch.setattr(models, "train", lambda *a, **how: both.wait() + 1 and train(*a, **how))
    assert models.volume_study(rows, [0.5, 1.0], "linear").count() == 4


def test_threads_delete_their_own_tables(spark):
    with scratch_tables(spark):
        mine = scratch_folder(spark, "mine")
        spark.range(1).write.parquet(mine)

        def other():
            with scratch_tables(spark):
                spark.range(1).write.parquet(scratch_folder(spark, "theirs"))

        thread = threading.Thread(target=other)
        thread.start()
        thread.join()
        assert spark.read.parquet(mine).count() == 1
