"""Aggregations, ranking and top-k reports over the tender table."""

from pyspark.sql import functions as F

from tenderlake import sinks
from tenderlake.catalog import fixtures as fx
from tenderlake.catalog.registry import query, rounded
from tenderlake.operators import aggregates, layout, quantiles, ranking, regression, search, sketches
from tenderlake.session import scratch_path


def _t(body: str) -> str:
    return fx.over("tenders", body=body)


def _valued(spark, sf_dir):
    """Tenders with the value column of the ETL record."""
    return fx.tenders(spark, sf_dir).withColumn("sum_value", F.floor("budget").cast("bigint"))


@query("totals_by_status", _t("""
    SELECT status, round(sum(budget), 2) AS total_budget, count(id) AS count FROM tenders GROUP BY status"""))
def _(spark, sf_dir):
    return rounded(aggregates.totals_by(fx.tenders(spark, sf_dir), "status"))


@query("category_region_summary", _t("""
    SELECT category, region, count(*) AS count, CAST(sum(CAST(floor(budget) AS bigint)) AS bigint) AS total_value,
           round(avg(CAST(floor(budget) AS bigint)), 2) AS avg_value,
           max(CAST(floor(budget) AS bigint)) AS max_value, min(CAST(floor(budget) AS bigint)) AS min_value
    FROM tenders GROUP BY category, region"""))
def category_region_summary(spark, sf_dir):
    return rounded(aggregates.by_dimensions(_valued(spark, sf_dir)))


@query("category_summary", _t("""
    SELECT category, count(*) AS count, round(avg(budget), 2) AS avg_budget, round(max(budget), 2) AS max_budget,
           round(min(budget), 2) AS min_budget FROM tenders GROUP BY category"""))
def _(spark, sf_dir):
    return rounded(aggregates.category_summary(fx.tenders(spark, sf_dir)))


@query("category_totals", _t("""
    SELECT category, count(*) AS count, round(sum(budget), 2) AS total_budget, round(avg(budget), 2) AS avg_budget,
           round(max(budget), 2) AS max_budget, round(min(budget), 2) AS min_budget
    FROM tenders GROUP BY category"""))
def _(spark, sf_dir):
    return rounded(aggregates.category_totals(fx.tenders(spark, sf_dir)))


@query("region_totals", _t("""
    SELECT region, count(*) AS count, round(sum(budget), 2) AS total_budget, round(avg(budget), 2) AS avg_budget
    FROM tenders GROUP BY region"""))
def _(spark, sf_dir):
    return rounded(aggregates.region_totals(fx.tenders(spark, sf_dir)))


@query("overall_totals", _t("""
    SELECT round(sum(budget), 2) AS total_budget, round(avg(budget), 2) AS avg_budget,
           round(max(budget), 2) AS max_budget, round(min(budget), 2) AS min_budget, count(*) AS count
    FROM tenders"""))
def _(spark, sf_dir):
    return rounded(aggregates.overall_totals(fx.tenders(spark, sf_dir)))


@query("column_profile", """
    SELECT count(*) AS row_count, CAST(11 AS bigint) AS column_count, count(l_extendedprice) AS count,
           round(avg(l_extendedprice), 2) AS avg, round(min(l_extendedprice), 2) AS min,
           round(max(l_extendedprice), 2) AS max FROM lineitem""")
def _(spark, sf_dir):
    return rounded(aggregates.column_profile(fx.table(spark, sf_dir, "lineitem"), "l_extendedprice"))


@query("average_by_category", _t("""
    SELECT category, round(avg(budget), 2) AS avg_budget FROM tenders GROUP BY category"""))
def _(spark, sf_dir):
    return rounded(aggregates.average_by(fx.tenders(spark, sf_dir), "category"))


@query("highest_average_regions", _t("""
    SELECT region, round(avg(budget), 2) AS avg_budget FROM tenders GROUP BY region ORDER BY avg(budget) DESC, region"""))
def _(spark, sf_dir):
    return rounded(aggregates.average_by(fx.tenders(spark, sf_dir), "region"))


@query("total_stats", _t("""
    SELECT count(*) AS total_count, count(DISTINCT category) AS categories_count,
           count(DISTINCT region) AS regions_count, count(DISTINCT organization) AS organizations_count,
           count(DISTINCT status) AS statuses_count, round(coalesce(avg(budget), 0), 2) AS avg_budget,
           round(coalesce(sum(budget), 0), 2) AS total_budget, round(coalesce(min(budget), 0), 2) AS min_budget,
           round(coalesce(max(budget), 0), 2) AS max_budget
    FROM tenders WHERE budget IS NOT NULL"""))
def _(spark, sf_dir):
    return rounded(search.total_stats(fx.tenders(spark, sf_dir)))


# A sketch of 2^14 registers is off by 0.65 % on average; few values are counted exactly.
@query("total_stats_of_loads", _t("""
    SELECT count(*) AS total_count, count(DISTINCT category) AS category_count, count(DISTINCT region) AS region_count,
           true AS organizations_near, count(DISTINCT status) AS status_count, round(avg(budget), 2) AS avg_budget,
           round(sum(budget), 2) AS total_budget, round(min(budget), 2) AS min_budget, round(max(budget), 2) AS max_budget
    FROM tenders WHERE budget IS NOT NULL"""))
def _(spark, sf_dir):
    """Dashboard totals over four loads, one of them repeated, from what each load has left of itself."""
    path, rows = scratch_path(spark, "sketches"), fx.tenders(spark, sf_dir)
    for k in (0, 1, 2, 3, 2):
        sinks.write_sketch(rows.where(F.col("id") % 4 == k), path, f"r{k}")
    found = sketches.merged_stats(spark.read.parquet(path))
    exact = rows.agg(F.count_distinct("organization")).scalar()
    near = F.abs(F.col("organization_count") / exact - 1) < 0.03
    return rounded(found.withColumn("organizations_near", near).drop("organization_count"))


@query("budget_range", fx.over("dirty_tenders", body="""
    SELECT coalesce(min(budget), 0) AS min_budget, coalesce(max(budget), 1000000) AS max_budget
    FROM dirty_tenders WHERE budget IS NOT NULL AND budget > 0"""))
def _(spark, sf_dir):
    return search.budget_range(fx.dirty_tenders(spark, sf_dir))


@query("results_stats", fx.over("dirty_tenders", body="""
    SELECT count(*) AS count, round(coalesce(avg(try_cast(budget_text AS double)), 0), 2) AS avg_budget,
           round(coalesce(sum(try_cast(budget_text AS double)), 0), 2) AS total_budget,
           round(coalesce(min(try_cast(budget_text AS double)), 0), 2) AS min_budget,
           round(coalesce(max(try_cast(budget_text AS double)), 0), 2) AS max_budget,
           count(DISTINCT category) AS categories, count(DISTINCT region) AS regions
    FROM dirty_tenders"""))
def _(spark, sf_dir):
    return rounded(search.results_stats(fx.dirty_tenders(spark, sf_dir), "budget_text"))


for _column in ("category", "status", "source"):
    @query(f"value_counts_{_column}", _t(f"""
        SELECT {_column}, count(*) AS count FROM tenders GROUP BY {_column}"""))
    def _(spark, sf_dir, column=_column):
        return aggregates.value_counts(fx.tenders(spark, sf_dir), column)


@query("distinct_counts", _t("""
    SELECT count(DISTINCT category) AS category_count, count(DISTINCT region) AS region_count,
           count(DISTINCT status) AS status_count, count(DISTINCT source) AS source_count FROM tenders"""))
def _(spark, sf_dir):
    return aggregates.distinct_counts(fx.tenders(spark, sf_dir), ["category", "region", "status", "source"])


# Quartiles of cents fall on exact halves of a cent, so four digits are compared.
@query("describe_budget", fx.over("dirty_tenders", body="""
    SELECT count(budget) AS count, round(avg(budget), 4) AS mean, round(stddev_samp(budget), 4) AS std,
           round(min(budget), 4) AS min, round(quantile_cont(budget, 0.25), 4) AS q25,
           round(quantile_cont(budget, 0.5), 4) AS q50, round(quantile_cont(budget, 0.75), 4) AS q75,
           round(max(budget), 4) AS max FROM dirty_tenders"""))
def _(spark, sf_dir):
    return rounded(quantiles.describe_numeric(fx.dirty_tenders(spark, sf_dir), "budget"), 4)


@query("median_budget", "SELECT round(median(o_totalprice), 3) AS median FROM orders")
def _(spark, sf_dir):
    return rounded(quantiles.median(fx.table(spark, sf_dir, "orders"), "o_totalprice"), 3)


@query("price_quantiles", """
    SELECT p AS probability, round(v, 4) AS value FROM (
      SELECT unnest([0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]::double[]) AS p,
             unnest(quantile_cont(l_extendedprice, [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0])) AS v
      FROM lineitem) q""")
def _(spark, sf_dir):
    return rounded(quantiles.exact_quantiles(fx.table(spark, sf_dir, "lineitem"), "l_extendedprice",
                                             [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]), 4)


# Within a rank error of 1/10,000 of the exact quantile, hence between its neighbours' quantiles.
@query("price_quantiles_approximate", """
    SELECT unnest([0.25, 0.5, 0.75]::double[]) AS probability, true AS within_error""")
def _(spark, sf_dir):
    lines = fx.table(spark, sf_dir, "lineitem")
    probabilities, error = [0.25, 0.5, 0.75], 0.0005
    sketch = quantiles.approximate_quantiles(lines, "l_extendedprice", probabilities)
    for name, shift in (("low", -error), ("high", error)):
        edge = quantiles.exact_quantiles(lines, "l_extendedprice", [p + shift for p in probabilities]) \
            .select(F.round(F.col("probability") - shift, 6).alias("probability"), F.col("value").alias(name))
        sketch = sketch.join(edge, "probability")
    return sketch.select("probability", F.col("value").between(F.col("low"), F.col("high")).alias("within_error"))


@query("budget_histogram", _t("""
    SELECT bin, round(lo + (bin - 1) * (hi - lo) / 50, 6) AS low, round(lo + bin * (hi - lo) / 50, 6) AS high,
           count(*) AS count
    FROM (SELECT CAST(least(floor((budget - lo) * 50 / (hi - lo)) + 1, 50) AS integer) AS bin, lo, hi
          FROM tenders, (SELECT min(budget) AS lo, max(budget) AS hi FROM tenders) e) b
    GROUP BY bin, lo, hi"""))
def _(spark, sf_dir):
    return rounded(aggregates.histogram(fx.tenders(spark, sf_dir)), 6)


@query("price_histogram", """
    SELECT bin, count(*) AS count
    FROM (SELECT CAST(least(floor((l_extendedprice - lo) * 50 / (hi - lo)) + 1, 50) AS integer) AS bin
          FROM lineitem, (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem) e) b
    GROUP BY bin""")
def _(spark, sf_dir):
    return aggregates.histogram(fx.table(spark, sf_dir, "lineitem"), "l_extendedprice").select("bin", "count")


@query("rank_in_category", _t("""
    SELECT id, category, CAST(floor(budget) AS bigint) AS sum_value,
           row_number() OVER (PARTITION BY category ORDER BY CAST(floor(budget) AS bigint) DESC, id) AS rank
    FROM tenders"""))
def _(spark, sf_dir):
    return ranking.rank_by_value(_valued(spark, sf_dir).select("id", "category", "sum_value"))


@query("rank_lines_by_flag", """
    SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey, l_extendedprice,
           row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber,
                              l_partkey, l_suppkey) AS rank
    FROM lineitem""")
def _(spark, sf_dir):
    lines = fx.table(spark, sf_dir, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_partkey",
                                                       "l_suppkey", "l_extendedprice")
    order = [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return ranking.row_number_by(lines, ["l_returnflag"], order).drop("l_suppkey")


@query("top_categories_by_count", _t("""
    SELECT category, count(*) AS count FROM tenders GROUP BY category ORDER BY count DESC, category LIMIT 5"""))
def _(spark, sf_dir):
    return aggregates.top_groups_by_count(fx.tenders(spark, sf_dir), "category", 5)


@query("top_regions_by_count", _t("""
    SELECT region, count(*) AS count FROM tenders GROUP BY region ORDER BY count DESC, region LIMIT 10"""))
def _(spark, sf_dir):
    return aggregates.top_groups_by_count(fx.tenders(spark, sf_dir), "region", 10)


@query("top_regions_by_budget", _t("""
    SELECT region, round(sum(budget), 2) AS total_budget FROM tenders GROUP BY region
    ORDER BY sum(budget) DESC, region LIMIT 10"""))
def _(spark, sf_dir):
    return rounded(aggregates.top_groups_by_sum(fx.tenders(spark, sf_dir), "region", k=10))


@query("top_organizations_by_budget", _t("""
    SELECT organization, round(sum(budget), 2) AS total_budget FROM tenders GROUP BY organization
    ORDER BY sum(budget) DESC, organization LIMIT 5"""))
def _(spark, sf_dir):
    return rounded(aggregates.top_groups_by_sum(fx.tenders(spark, sf_dir), "organization", k=5))


@query("first_tenders", _t("""
    SELECT id, tender_no, round(budget, 2) AS budget FROM tenders ORDER BY published_at, id LIMIT 50"""))
def _(spark, sf_dir):
    return rounded(aggregates.first_rows(fx.tenders(spark, sf_dir), 50, ["published_at", "id"])
                   .select("id", "tender_no", "budget"))


@query("kept_frame", """
    SELECT o_orderstatus AS status, count(*) AS count, round(sum(o_totalprice), 2) AS total,
           round(100.0 * count(*) / (SELECT count(*) FROM orders), 4) AS share FROM orders GROUP BY o_orderstatus""")
def _(spark, sf_dir):
    """A frame that is read twice is kept while it is needed."""
    with layout.cached(fx.table(spark, sf_dir, "orders").select("o_orderstatus", "o_totalprice")) as kept:
        every = kept.count()
        totals = kept.groupBy(F.col("o_orderstatus").alias("status")).agg(
            F.count(F.lit(1)).alias("count"), F.round(F.sum("o_totalprice"), 2).alias("total"))
        rows = sinks.brought(totals.withColumn("share", F.round(F.lit(100.0) * F.col("count") / F.lit(every), 4)), most=100)
    return spark.createDataFrame(rows, "status string, count long, total double, share double")


@query("partition_totals", """
    SELECT count(*) AS total_records, CAST(16 AS bigint) AS num_partitions, round(count(*) / 16, 2) AS avg_per_partition
    FROM lineitem""")
def _(spark, sf_dir):
    spread = layout.spread_rows(fx.table(spark, sf_dir, "lineitem"), 16)
    return rounded(layout.partition_summary(spread).drop("skew"))


_FIT = """
    SELECT l_returnflag, sum(x * y) / sum(x * x) AS a, sum(y * y) AS yy, sum(x * y) AS xy, sum(x * x) AS xx,
           var_pop(y) * count(*) AS spread
    FROM (SELECT l_returnflag, l_quantity AS x, l_extendedprice AS y FROM lineitem) p GROUP BY l_returnflag"""


@query("origin_fit_by_flag", f"""
    SELECT l_returnflag, round(a, 6) AS coefficient, round(1 - (yy - xy * xy / xx) / spread, 6) AS r_squared,
           1 - (yy - xy * xy / xx) / spread > 0.95 AS is_linear FROM ({_FIT}) f""")
def _(spark, sf_dir):
    return rounded(regression.origin_fit(fx.table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice",
                                         ["l_returnflag"]), 6)


@query("power_fit_by_flag", """
    SELECT l_returnflag, round(s, 6) AS slope, round(i, 6) AS intercept, round(r, 6) AS r_squared,
           CASE WHEN s < 1.2 THEN 'linear' WHEN s < 2 THEN 'acceptable' ELSE 'needs optimisation' END AS complexity
    FROM (SELECT l_returnflag, regr_slope(ln(l_extendedprice), ln(l_quantity)) AS s,
                 regr_intercept(ln(l_extendedprice), ln(l_quantity)) AS i,
                 regr_r2(ln(l_extendedprice), ln(l_quantity)) AS r
          FROM lineitem WHERE l_extendedprice > 0 AND l_quantity > 0 GROUP BY l_returnflag) f""")
def _(spark, sf_dir):
    return rounded(regression.power_fit(fx.table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice",
                                        ["l_returnflag"]), 6)


_RUNS = "SELECT event_type, count(*) AS records, sum(value) AS seconds FROM events GROUP BY event_type"


def _runs(spark, sf_dir):
    return fx.table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("records"), F.sum("value").alias("seconds"))


@query("run_throughput", f"""
    SELECT event_type, records, round(seconds, 4) AS seconds, round(records / seconds, 4) AS rows_per_second,
           round(seconds * 1000000 / records, 4) AS seconds_per_million FROM ({_RUNS}) r""")
def _(spark, sf_dir):
    return rounded(regression.throughput(_runs(spark, sf_dir), "records", "seconds"), 4)


@query("throughput_spread", f"""
    SELECT round(max(x), 4) AS max, round(min(x), 4) AS min, round(avg(x), 4) AS mean, round(max(x) / min(x), 4) AS max_to_min
    FROM (SELECT records / seconds AS x FROM ({_RUNS}) r) t""")
def _(spark, sf_dir):
    return rounded(regression.spread(regression.throughput(_runs(spark, sf_dir), "records", "seconds"),
                                     "rows_per_second"), 4)
