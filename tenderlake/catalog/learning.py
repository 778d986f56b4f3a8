"""Feature preparation, model metrics and budget models."""

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tenderlake.catalog import fixtures as fx
from tenderlake.catalog.registry import DAY, as_text, query, rounded
from tenderlake.ml import features, models
from tenderlake.operators import ranking
from tenderlake.session import scratch_path


def _t(body: str) -> str:
    return fx.over("tenders", body=body)


@query("label_codes", _t("""
    SELECT id, dense_rank() OVER (ORDER BY category) - 1 AS category_code,
           dense_rank() OVER (ORDER BY organization) - 1 AS organization_code FROM tenders"""))
def _(spark, sf_dir):
    coded = ranking.label_encode(fx.tenders(spark, sf_dir), ["category", "organization"])
    return coded.select("id", "category_code", "organization_code")


@query("frequency_codes", _t("""
    SELECT t.id, c.code AS region_code FROM tenders t JOIN (
      SELECT region, CAST(row_number() OVER (ORDER BY count(*) DESC, region) - 1 AS double) AS code
      FROM tenders GROUP BY region) c USING (region)"""))
def _(spark, sf_dir):
    rows = fx.tenders(spark, sf_dir).select("id", "region")
    codes = ranking.code_tables(rows, ["region"], by_frequency=True)["region"]
    return rows.join(codes, rows.region == codes.label).select("id", F.col("code").cast("double").alias("region_code"))


@query("one_hot_status", """
    SELECT o_orderkey AS id, CAST(o_orderstatus = 'F' AS integer) AS status_F, CAST(o_orderstatus = 'O' AS integer) AS status_O
    FROM orders""")
def _(spark, sf_dir):
    rows = fx.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"))
    # The training rows lack one status; it is all zeros afterwards.
    coded = features.dummy_codes(rows, rows.where("status <> 'P'"), "status")
    one = lambda code: F.coalesce((F.col("status_code") == code).cast("int"), F.lit(0))
    return coded.select("id", one(0).alias("status_F"), one(1).alias("status_O"))


@query("standardise", fx.over("procurements", body="""
    SELECT id, round((quantity - (SELECT avg(quantity) FROM procurements)) / (SELECT stddev_pop(quantity) FROM procurements), 6) AS quantity_std,
           round((unit_price - (SELECT avg(unit_price) FROM procurements)) / (SELECT stddev_pop(unit_price) FROM procurements), 6) AS unit_price_std
    FROM procurements"""))
def _(spark, sf_dir):
    scaled = features.standardise(fx.procurements(spark, sf_dir), ["quantity", "unit_price"])
    return rounded(scaled.select("id", "quantity_std", "unit_price_std"), 6)


@query("hash_split", _t(f"""
    SELECT id, u < 0.8 AS is_train FROM {fx.uniform_sql("tenders", "id", features.SEED, "u")}"""))
def _(spark, sf_dir):
    return features.hash_split(fx.tenders(spark, sf_dir), "id").select("id", "is_train")


@query("regression_metrics", fx.over("procurements", body="""
    SELECT category, round(avg(e * e), 2) AS mse, round(sqrt(avg(e * e)), 2) AS rmse,
           round(1 - avg(e * e) / var_pop(total_cost), 6) AS r2, round(avg(abs(e)), 2) AS mae, count(*) AS size
    FROM (SELECT category, total_cost, total_cost - quantity * 1500 AS e FROM procurements) p GROUP BY category"""))
def _(spark, sf_dir):
    guessed = fx.procurements(spark, sf_dir).withColumn("prediction", F.col("quantity") * 1500)
    metrics = models.regression_metrics(guessed, groups=["category"])
    return metrics.withColumns({c: F.round(c, 6 if c == "r2" else 2) for c in ("mse", "rmse", "r2", "mae")})


# Normal equations of two features, from the moments of the table.
@query("linear_fit", """
    WITH m AS (SELECT var_pop(l_quantity) AS a, var_pop(l_discount) AS d, covar_pop(l_quantity, l_discount) AS c,
                      covar_pop(l_quantity, l_extendedprice) AS p, covar_pop(l_discount, l_extendedprice) AS q,
                      avg(l_quantity) AS x, avg(l_discount) AS y, avg(l_extendedprice) AS z FROM lineitem),
    s AS (SELECT *, (p * d - q * c) / (a * d - c * c) AS u, (q * a - p * c) / (a * d - c * c) AS v FROM m)
    SELECT round(u, 3) AS quantity_slope, round(v, 3) AS discount_slope, round(z - u * x - v * y, 3) AS intercept FROM s""")
def _(spark, sf_dir):
    lines = fx.table(spark, sf_dir, "lineitem").select("l_quantity", "l_discount", "l_extendedprice")
    stages = [VectorAssembler(inputCols=["l_quantity", "l_discount"], outputCol="features"),
              models.regressor("linear", label="l_extendedprice", solver="normal")]
    model = Pipeline(stages=stages).fit(lines).stages[-1]
    row = [float(c) for c in (*model.coefficients, model.intercept)]
    return rounded(spark.createDataFrame([row], "quantity_slope double, discount_slope double, intercept double"), 3)


def split_sql(share: float = 1.0) -> str:
    """The rows of a nested share with their split, as the fits see them."""
    rows = fx.uniform_sql("procurements", "id", features.SEED, "u")
    if share < 1:
        rows = f"(SELECT * FROM {fx.uniform_sql(rows, 'id', features.SEED + 7, 'drawn')} WHERE drawn < {share})"
    return f"(SELECT *, u < {features.TRAIN_SHARE} AS is_train FROM {rows})"


def least_squares_sql() -> str:
    """Metrics of the linear cost model by split: moments of the training rows, eliminated one unknown after the other."""
    names, n = features.CATEGORICAL + features.NUMERICAL, len(features.CATEGORICAL + features.NUMERICAL)
    joins = " ".join(f"LEFT JOIN codes_{c} ON label_{c} = {c}" for c in features.CATEGORICAL)
    values = ", ".join(f"coalesce(code_{c}, (SELECT count(*) FROM codes_{c}))::double" if c in features.CATEGORICAL else f"{c}::double"
                       for c in names)
    parts = [f"split AS MATERIALIZED (SELECT *, row_number() OVER () AS rid FROM {split_sql()})",
             *(f"codes_{c} AS (SELECT {c} AS label_{c}, row_number() OVER (ORDER BY {c}) - 1 AS code_{c} FROM split WHERE is_train GROUP BY {c})"
               for c in features.CATEGORICAL),
             f"vectors AS MATERIALIZED (SELECT rid, is_train, total_cost AS y, [{values}, total_cost] AS x FROM split {joins})",
             f"""long AS MATERIALIZED (SELECT rid, is_train, unnest(x) AS v, unnest(range({n + 1})) AS k FROM vectors)""",
             """scale AS MATERIALIZED (SELECT k, avg(v) AS mean, CASE WHEN stddev_pop(v) > 0 THEN stddev_pop(v) ELSE 1 END AS dev
                 FROM long WHERE is_train GROUP BY k)""",
             """scaled AS MATERIALIZED (SELECT rid, k, (v - mean) / dev AS v FROM long JOIN scale USING (k) WHERE is_train)""",
             f"""m0 AS MATERIALIZED (SELECT a.k AS i, b.k AS j, avg(a.v * b.v) AS v FROM scaled a JOIN scaled b USING (rid)
                 WHERE a.k < {n} GROUP BY a.k, b.k)"""]
    for k in range(n):
        # An unknown that others explain wholly, or a constant one, counts as zero.
        parts.append(f"""m{k + 1} AS MATERIALIZED (SELECT a.i, a.j, CASE WHEN abs(p.v) < 1e-9 THEN CASE WHEN a.i = {k} THEN 0 ELSE a.v END
            WHEN a.i = {k} THEN a.v / p.v ELSE a.v - c.v * r.v / p.v END AS v
            FROM m{k} a JOIN m{k} p ON p.i = {k} AND p.j = {k} JOIN m{k} r ON r.i = {k} AND r.j = a.j
            JOIN m{k} c ON c.j = {k} AND c.i = a.i)""")
    parts.append(f"""slopes AS (SELECT m.i AS k, m.v * y.dev / s.dev AS slope, s.mean FROM m{n} m JOIN scale s ON s.k = m.i
        JOIN scale y ON y.k = {n} WHERE m.j = {n})""")
    parts.append(f"""predicted AS (SELECT rid, is_train, max(v) FILTER (l.k = {n}) AS y,
        (SELECT mean FROM scale WHERE k = {n}) + sum(slope * (v - mean)) AS p
        FROM long l LEFT JOIN slopes USING (k) GROUP BY rid, is_train)""")
    return "WITH " + ",\n".join(parts) + """
        SELECT is_train, round(avg((y - p) ** 2) / 1e6, 3) AS mse_mln, round(sqrt(avg((y - p) ** 2)), 3) AS rmse,
               round(1 - avg((y - p) ** 2) / var_pop(y), 7) AS r2, round(avg(abs(y - p)), 3) AS mae, count(*) AS size
        FROM predicted GROUP BY is_train"""


def _numbers(metrics, *groups):
    return metrics.select(*groups, "is_train", F.round(F.col("mse") / 1e6, 3).alias("mse_mln"), F.round("rmse", 3).alias("rmse"),
                          F.round("r2", 7).alias("r2"), F.round("mae", 3).alias("mae"), "size")


@query("cost_model_linear", fx.over("procurements", body=least_squares_sql()))
def _(spark, sf_dir):
    return _numbers(models.train(fx.procurements(spark, sf_dir), "linear", keep=scratch_path(spark, "predictions"))[1])


# Trees have no SQL form. The SQL side states the rows of each split, and that rows are predicted better than by their mean;
# tests compute the metrics again from the stored predictions.
def _explained(metrics, *groups):
    return metrics.select(*groups, "is_train", "size", (F.col("r2") > 0.9).alias("explained"))


_SIZES = "SELECT is_train, count(*) AS size, true AS explained FROM {rows} GROUP BY is_train"


@query("cost_model_boosted", fx.over("procurements", body=_SIZES.format(rows=split_sql())))
def _(spark, sf_dir):
    return _explained(models.train(fx.procurements(spark, sf_dir), "gradient_boosting")[1])


@query("cost_model_forest", fx.over("procurements", body=_SIZES.format(rows=split_sql())))
def _(spark, sf_dir):
    return _explained(models.train(fx.procurements(spark, sf_dir), "random_forest")[1])


# Labels of single tenders: as many codes as rows. A forest predicts averages of training labels.
@query("frequency_forest", _t(f"""
    WITH split AS (SELECT *, u < 0.8 AS is_train FROM {fx.uniform_sql("tenders", "id", features.SEED, "u")}),
    codes AS (SELECT tender_no, row_number() OVER (ORDER BY count(*) DESC, tender_no) - 1 AS code FROM split WHERE is_train
              GROUP BY tender_no)
    SELECT s.id, s.is_train, coalesce(c.code, (SELECT count(*) FROM codes)) AS tender_index, true AS within_labels
    FROM split s LEFT JOIN codes c ON c.tender_no = s.tender_no"""))
def _(spark, sf_dir):
    rows = features.hash_split(fx.tenders(spark, sf_dir).withColumnRenamed("budget", "label"), "id")
    training = rows.where("is_train")
    predicted = models.frequency_forest(columns=[*models.FOREST_COLUMNS, "tender_no"]).fit(training).transform(rows)
    edges = training.agg(F.struct(F.min("label").alias("low"), F.max("label").alias("high"))).scalar()
    return predicted.withColumn("edges", edges).select(
        "id", "is_train", F.col("tender_no_index").cast("long").alias("tender_index"),
        F.col("prediction").between(F.col("edges.low"), F.col("edges.high")).alias("within_labels"))


_FORECAST = """
    WITH head AS (SELECT category, region, status, row_number() OVER (ORDER BY published_at, id) AS day FROM tenders
                  ORDER BY published_at, id LIMIT 30)
    SELECT CAST(day AS integer) AS day, category, region, status,
           strftime((SELECT CAST(max(published_at) AS date) FROM tenders) + CAST(day AS integer), '%Y-%m-%d') AS forecast_on
           MORE
    FROM head"""


@query("forecast_frame", _t(_FORECAST.replace("MORE", "")))
def _(spark, sf_dir):
    return as_text(features.forecast_frame(fx.tenders(spark, sf_dir)), forecast_on=DAY)


# A forest predicts averages of the training labels, so every forecast lies between their extremes.
@query("budget_forecast", _t(_FORECAST.replace("MORE", ", true AS within_labels")))
def _(spark, sf_dir):
    rows = fx.tenders(spark, sf_dir)
    edges = rows.agg(F.struct(F.min("budget").alias("low"), F.max("budget").alias("high"))).scalar()
    forecast = models.forecast(models.train_forecast(rows), rows).withColumn("edges", edges)
    within = F.col("predicted_budget").between(F.col("edges.low"), F.col("edges.high"))
    return as_text(forecast.select("day", "category", "region", "status", "forecast_on", within.alias("within_labels")),
                   forecast_on=DAY)


@query("stored_model", """
    SELECT count(*) AS rows, 0 AS mismatches FROM orders""")
def _(spark, sf_dir):
    path = scratch_path(spark, "model")
    rows = fx.tenders(spark, sf_dir).withColumnRenamed("budget", "label")
    model = models.frequency_forest().fit(rows)
    models.save(model, path)
    before = model.transform(rows).select("id", F.col("prediction").alias("p"))
    after = models.load_coded(spark, path).transform(rows).select("id", F.col("prediction").alias("q"))
    return before.join(after, "id").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("p") != F.col("q")).alias("mismatches"))


_SHARES = [0.25, 0.5, 1.0]


@query("volume_study", fx.over("procurements", body=" UNION ALL ".join(
    f"SELECT {share}::double AS share, is_train, count(*) AS size, true AS explained FROM {split_sql(share)} GROUP BY is_train"
    for share in _SHARES)))
def _(spark, sf_dir):
    return _explained(models.volume_study(fx.procurements(spark, sf_dir), _SHARES), "share")


@query("volume_study_linear", fx.over("procurements", body=" UNION ALL ".join(
    f"SELECT {share}::double AS share, * FROM ({least_squares_sql().replace(split_sql(), split_sql(share))})" for share in _SHARES)))
def _(spark, sf_dir):
    study = models.volume_study(fx.procurements(spark, sf_dir), _SHARES, "linear")
    return _numbers(study, "share")


@query("trained_models", fx.over("procurements", body=f"""
    SELECT m.model, s.is_train, s.size, CASE WHEN m.model = 'linear' THEN l.r2 END AS linear_r2
    FROM (SELECT is_train, count(*) AS size FROM {split_sql()} GROUP BY is_train) s,
         (SELECT unnest(['linear', 'gradient_boosting', 'random_forest']) AS model) m,
         ({least_squares_sql()}) l WHERE l.is_train = s.is_train"""))
def _(spark, sf_dir):
    trained = models.train_all(fx.procurements(spark, sf_dir), scratch_path(spark, "models"))
    return trained.select("model", "is_train", "size", F.when(F.col("model") == "linear", F.round("r2", 7)).alias("linear_r2"))
