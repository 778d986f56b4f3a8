"""Training, evaluation, storage and forecasting of budget models."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial, reduce

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import OneHotEncoder, StandardScaler, VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.functions import dates, numbers
from tenderlake.ml import features as prep
from tenderlake.ml import trees as binned
from tenderlake.operators.ranking import code_tables
from tenderlake.session import folders, scratch_tables, stored

KINDS = ("linear", "gradient_boosting", "random_forest")
FOREST_COLUMNS = ["category", "region", "status"]


def regressor(kind: str, features: str = "features", label: str = prep.LABEL, **overrides):
    """Estimator with the default parameters of its kind."""
    common = {"featuresCol": features, "labelCol": label}
    if kind == "linear":
        return LinearRegression(**{**common, **overrides})
    if kind == "gradient_boosting":
        return binned.BoostedTrees(**{**common, "maxIter": 100, "stepSize": 0.1, "maxDepth": 5, "seed": prep.SEED, **overrides})
    if kind == "random_forest":
        return binned.BaggedTrees(**{**common, "numTrees": 50, "maxDepth": 10, "seed": prep.SEED,
                                     "featureSubsetStrategy": "all", **overrides})
    raise ValueError(f"unknown model kind: {kind}")


@dataclass
class CodedModel:
    """A fitted pipeline behind label codes, which are tables and are joined, however many labels there are."""

    codes: dict[str, DataFrame]
    fitted: PipelineModel

    def transform(self, df: DataFrame) -> DataFrame:
        return self.fitted.transform(_coded(df, self.codes))


def _coded(df: DataFrame, codes: dict[str, DataFrame]) -> DataFrame:
    """Add ``<column>_index``; a label unseen in training, or none, gets the number after the last."""
    for column, table in codes.items():
        after = table.agg(F.count(F.lit(1))).scalar()
        named = table.select(F.col("label").alias("__label"), F.col("code").alias("__code"))
        df = df.join(named, F.col(column) == F.col("__label"), "left") \
            .withColumn(f"{column}_index", F.coalesce("__code", after).cast("double")).drop("__label", "__code")
    return df


@dataclass
class CodedPipeline:
    """Stages behind label codes of some columns; what is fitted knows labels by joined tables only.

    ``others`` are the columns that the stages read beside the codes.
    """

    columns: list[str]
    stages: list
    others: list[str]
    by_frequency: bool = False

    def reads(self) -> list[str]:
        return [f"{c}_index" for c in self.columns] + self.others

    def fit(self, training: DataFrame) -> CodedModel:
        codes = code_tables(training, self.columns, self.by_frequency)
        with scratch_tables(training.sparkSession):
            return CodedModel(codes, self.fit_coded(stored(_coded(training, codes).select(self.reads()), "model-rows")))

    def fit_coded(self, rows: DataFrame) -> PipelineModel:
        """Fit on stored rows that have their codes: the stages read them several times, trees keep their own binned form."""
        return Pipeline(stages=self.stages).fit(rows)


def cost_pipeline(kind: str, categorical: list[str] = prep.CATEGORICAL, numerical: list[str] = prep.NUMERICAL,
                  label: str = prep.LABEL, **overrides) -> CodedPipeline:
    """Alphabetical codes, assembly, standardisation, regression."""
    stages = [VectorAssembler(inputCols=[f"{c}_index" for c in categorical] + numerical, outputCol="assembled"),
              StandardScaler(inputCol="assembled", outputCol="features", withMean=True, withStd=True),
              regressor(kind, label=label, **overrides)]
    return CodedPipeline(categorical, stages, [*numerical, label])


def fit_cost_model(training: DataFrame, kind: str, **how) -> CodedModel:
    return cost_pipeline(kind, **how).fit(training)


def frequency_forest(label: str = "label", trees: int = 10, depth: int = 5, columns: list[str] = FOREST_COLUMNS) -> CodedPipeline:
    """Frequency-ordered codes of category, region and status (or other columns), scaling, small forest."""
    stages = [VectorAssembler(inputCols=[f"{c}_index" for c in columns], outputCol="features"),
              StandardScaler(inputCol="features", outputCol="scaled_features"),
              RandomForestRegressor(featuresCol="scaled_features", labelCol=label, numTrees=trees, maxDepth=depth,
                                    seed=prep.SEED)]
    return CodedPipeline(columns, stages, [label], by_frequency=True)


def rmse(predictions: DataFrame, label: str = "label") -> float:
    return RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse").evaluate(predictions)


def regression_metrics(predictions: DataFrame, label: str = prep.LABEL, groups: list[str] | None = None) -> DataFrame:
    """MSE, RMSE, R2, MAE and size in one aggregation, per group when asked."""
    error = F.col(label) - F.col("prediction")
    mse = F.avg(error * error)
    return predictions.groupBy(*(groups or [])).agg(
        mse.alias("mse"), F.sqrt(mse).alias("rmse"),
        (F.lit(1.0) - F.try_divide(mse, F.var_pop(label))).alias("r2"),
        F.avg(F.abs(error)).alias("mae"), F.count(F.lit(1)).alias("size"))


def train(df: DataFrame, kind: str, key: str = "id", keep: str | None = None, **overrides) -> tuple[CodedModel, DataFrame]:
    """Fit on the training split; returns the model and its metrics per split.

    ``keep`` is a folder for the predictions (key, split, label, prediction) that the metrics are of.
    The rows are joined with their codes once, then read by the fit and for the predictions.
    """
    pipeline = cost_pipeline(kind, **overrides)
    with scratch_tables(df.sparkSession):
        return _trained(pipeline, *_coded_split(df, pipeline, key), key, keep)


def _coded_split(df: DataFrame, pipeline: CodedPipeline, key: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The rows of both splits with the codes of the training split, stored, and these codes."""
    split = prep.hash_split(df, key)
    codes = code_tables(split.where("is_train"), pipeline.columns, pipeline.by_frequency)
    return stored(_coded(split, codes).select(key, "is_train", *pipeline.reads()), "model-rows"), codes


def _trained(pipeline: CodedPipeline, rows: DataFrame, codes: dict[str, DataFrame], key: str,
             keep: str | None) -> tuple[CodedModel, DataFrame]:
    spark = rows.sparkSession
    model = CodedModel(codes, pipeline.fit_coded(rows.where("is_train")))
    predicted = model.fitted.transform(rows)
    if keep is not None:
        predicted.select(key, "is_train", prep.LABEL, "prediction").write.mode("overwrite").parquet(keep)
        predicted = spark.read.parquet(keep)
    metrics = regression_metrics(predicted, groups=["is_train"])
    # One row for each split: they are brought here, as the stored rows go.
    return model, spark.createDataFrame(metrics.collect(), metrics.schema)


def _side_by_side(spark: SparkSession, tasks: list[Callable[[], DataFrame]]) -> DataFrame:
    """Metrics of several fits that run at the same time: the many short passes of one leave cores to the others."""
    with ThreadPoolExecutor(max(len(tasks), 1)) as pool:
        return reduce(DataFrame.unionByName, [f.result() for f in [pool.submit(inheritable_thread_target(spark)(t)) for t in tasks]])


def _source(df: DataFrame, key: str) -> DataFrame:
    """What the cost models read of a table, derived once."""
    return stored(df.select(key, *prep.CATEGORICAL, *prep.NUMERICAL, prep.LABEL), "model-source")


def train_all(df: DataFrame, folder: str, kinds=KINDS, key: str = "id",
              overrides: dict[str, dict] | None = None) -> DataFrame:
    """Train and store every kind, with its predictions; one metrics row per kind and split."""
    def fit(kind: str, pipeline: CodedPipeline, rows: DataFrame, codes: dict[str, DataFrame]) -> DataFrame:
        place = f"{folder.rstrip('/')}/{kind}"
        with scratch_tables(rows.sparkSession):
            model, metrics = _trained(pipeline, rows, codes, key, f"{place}/predictions")
            save(model, place)
            return metrics.withColumn("model", F.lit(kind))

    pipelines = {kind: cost_pipeline(kind, **(overrides or {}).get(kind, {})) for kind in kinds}
    with scratch_tables(df.sparkSession):
        source, shared, tasks = _source(df, key), {}, []
        for kind, pipeline in pipelines.items():
            # Kinds that read the same columns share the rows with their codes.
            reads = (*pipeline.columns, *pipeline.others)
            if reads not in shared:
                shared[reads] = _coded_split(source, pipeline, key)
            tasks.append(partial(fit, kind, pipeline, *shared[reads]))
        return _side_by_side(df.sparkSession, tasks)


def save(model: CodedModel | PipelineModel, path: str) -> None:
    """Store a model with its preprocessing."""
    if isinstance(model, CodedModel):
        for column, table in model.codes.items():
            table.write.mode("overwrite").parquet(f"{path}/codes/column={column}")
        model.fitted.write().overwrite().save(f"{path}/fitted")
    else:
        model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_coded(spark: SparkSession, path: str) -> CodedModel:
    columns = folders(spark, f"{path}/codes", "column")
    codes = {c: spark.read.schema("label string, code bigint").parquet(f"{path}/codes/column={c}") for c in columns}
    return CodedModel(codes, load(f"{path}/fitted"))


def volume_study(df: DataFrame, shares: list[float], kind: str = "gradient_boosting", key: str = "id",
                 **overrides) -> DataFrame:
    """Metrics against data volume: nested samples, one fit each."""
    with scratch_tables(df.sparkSession):
        source = _source(df, key)

        def fit(share: float) -> DataFrame:
            sample = source.where(numbers.stable_uniform(key, prep.SEED + 7) < F.lit(share))
            _, metrics = train(sample, kind, key, **overrides)
            return metrics.withColumns({"share": F.lit(share), "model": F.lit(kind)})

        return _side_by_side(df.sparkSession, [partial(fit, share) for share in shares])


def forecast_pipeline(label: str = "budget", trees: int = 50, depth: int = 10,
                      columns: list[str] = FOREST_COLUMNS) -> CodedPipeline:
    """One-hot category, region, status (or other columns) and epoch seconds into a forest.

    The dummies are sparse vectors made from the joined codes; the encoder
    keeps the number of codes, no labels.
    """
    stages = [OneHotEncoder(inputCols=[f"{c}_index" for c in columns], outputCols=[f"{c}_hot" for c in columns],
                            handleInvalid="keep"),
              VectorAssembler(inputCols=[f"{c}_hot" for c in columns] + ["day_seconds"], outputCol="features"),
              regressor("random_forest", label=label, numTrees=trees, maxDepth=depth)]
    return CodedPipeline(columns, stages, ["day_seconds", label])


def train_forecast(df: DataFrame, trees: int = 50, depth: int = 10) -> CodedModel:
    training = df.select(*FOREST_COLUMNS, "budget", dates.epoch_seconds("published_at").alias("day_seconds"))
    return forecast_pipeline(trees=trees, depth=depth).fit(training)


def forecast(model: CodedModel, df: DataFrame, days: int = 30) -> DataFrame:
    """Predicted budget for each of the next days: (forecast_on, category, region, status, predicted_budget)."""
    future = prep.forecast_frame(df, days).withColumn("day_seconds", dates.epoch_seconds("forecast_on"))
    return model.transform(future).select("day", "forecast_on", "category", "region", "status",
                                          F.col("prediction").alias("predicted_budget"))
