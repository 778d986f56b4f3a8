"""Round trips through files, tables and layers."""

import uuid
from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenderlake import schema, sinks
from tenderlake.catalog import fixtures as fx
from tenderlake.catalog.registry import DAY, as_text, query, rounded
from tenderlake.operators import aggregates, layers, layout
from tenderlake.plans import batch_etl
from tenderlake.session import scratch_path
from tenderlake.sources import files, tables

CLOCK = datetime(2024, 2, 1, 12, 0)
_FLAT = "id bigint, tender_no string, category string, region string, budget double, published_on string"
_ROWS = """SELECT id, tender_no, category, region, budget, strftime(published_at, '%Y-%m-%d') AS published_on FROM tenders"""


def _t(body: str) -> str:
    return fx.over("tenders", body=body)


def _flat(spark, sf_dir):
    return fx.tenders(spark, sf_dir).select("id", "tender_no", "category", "region", "budget",
                                            F.date_format("published_at", DAY).alias("published_on"))


@query("csv_scan", _t(_ROWS))
def _(spark, sf_dir):
    path = sinks.write_csv(_flat(spark, sf_dir), scratch_path(spark, "csv"))
    return files.read_csv(spark, path, _FLAT)


@query("csv_scan_inferred", _t("""
    SELECT count(*) AS n, round(sum(budget), 2) AS total_budget, CAST(sum(id) AS bigint) AS ids FROM tenders"""))
def _(spark, sf_dir):
    path = sinks.write_csv(_flat(spark, sf_dir), scratch_path(spark, "csv"))
    read = files.read_csv(spark, path)
    return rounded(read.agg(F.count(F.lit(1)).alias("n"), F.sum("budget").alias("total_budget"),
                            F.sum("id").cast("bigint").alias("ids")))


@query("json_scan", _t(_ROWS))
def _(spark, sf_dir):
    path = sinks.write_json(_flat(spark, sf_dir), scratch_path(spark, "json"))
    return files.read_json(spark, path, _FLAT)


@query("parquet_scan", """
    SELECT o_orderkey, round(o_totalprice, 2) AS o_totalprice FROM orders WHERE o_orderstatus = 'F'""")
def _(spark, sf_dir):
    orders = files.read_parquet(spark, f"{sf_dir}/orders.parquet")
    return rounded(orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice"))


@query("scan_by_extension", _t("""
    SELECT f.format, count(*) AS n, round(sum(budget), 2) AS total_budget
    FROM tenders, (SELECT 'csv' AS format UNION ALL SELECT 'json' UNION ALL SELECT 'parquet') f GROUP BY f.format"""))
def _(spark, sf_dir):
    root, rows = scratch_path(spark, "any"), _flat(spark, sf_dir)
    sinks.write_parquet(rows, f"{root}/t.parquet")
    stored = files.read_parquet(spark, f"{root}/t.parquet")
    sinks.write_csv(stored, f"{root}/t.csv")
    sinks.write_json(stored, f"{root}/t.json")
    read = [files.read_any(spark, f"{root}/t.{kind}", None if kind == "parquet" else _FLAT)
            .select("budget", F.lit(kind).alias("format")) for kind in ("csv", "json", "parquet")]
    return rounded(files.union_feeds(*read).groupBy("format").agg(F.count(F.lit(1)).alias("n"),
                                                                 F.sum("budget").alias("total_budget")))


@query("csv_upload", _t("""
    SELECT lpad(CAST(id AS string), 12, '0') AS tender_no, organization, category, region, budget FROM tenders"""))
def _(spark, sf_dir):
    path = scratch_path(spark, "upload")
    # Numbers with leading zeros are names, not integers.
    rows = fx.tenders(spark, sf_dir).select(F.lpad(F.col("id").cast("string"), 12, "0").alias("tender_no"), "organization",
                                            "category", "region", "budget")
    return files.read_upload(spark, sinks.write_csv(rows, path, byte_order_mark=True))


@query("table_scan_fallback", _t("""
    SELECT id, tender_no FROM tenders ORDER BY published_at DESC, id LIMIT 500"""))
def _(spark, sf_dir):
    suffix = uuid.uuid4().hex
    rows = tables.register(fx.tenders(spark, sf_dir), f"raw_{suffix}")
    tables.register(rows.limit(0), f"main_{suffix}")
    return tables.scan_table(spark, f"main_{suffix}", f"raw_{suffix}", [F.desc("published_at"), "id"], 500) \
        .select("id", "tender_no")


@query("table_count_fallback", "SELECT count(*) AS count FROM orders")
def _(spark, sf_dir):
    name = f"orders_{uuid.uuid4().hex}"
    tables.register(fx.table(spark, sf_dir, "orders"), name)
    return tables.count_table(spark, "no_such_table", name)


@query("sql_view", _t("""
    SELECT region, count(*) AS count, round(avg(budget), 2) AS avg_budget FROM tenders GROUP BY region
    ORDER BY count DESC, region LIMIT 5"""))
def _(spark, sf_dir):
    name = f"tenders_{uuid.uuid4().hex}"
    tables.register(fx.tenders(spark, sf_dir), name)
    return tables.run_sql(spark, f"""
        SELECT region, count(*) AS count, round(avg(budget), 2) AS avg_budget FROM {name} GROUP BY region
        ORDER BY count DESC, region LIMIT 5""")


@query("sql_parameters", _t("""
    SELECT category, count(*) AS count FROM tenders WHERE budget > 250000 AND status = 'O' GROUP BY category"""))
def _(spark, sf_dir):
    return tables.run_sql(spark, """
        SELECT category, count(*) AS count FROM {tenders} WHERE budget > :floor AND status = :status
        GROUP BY category""", {"floor": 250_000.0, "status": "O"}, tenders=fx.tenders(spark, sf_dir))


@query("layer_load", _t("""
    SELECT 'stored' AS layer, count(*) AS n FROM tenders UNION ALL SELECT 'missing', 0"""))
def _(spark, sf_dir):
    root = scratch_path(spark, "layer")
    frame = fx.tenders(spark, sf_dir).withColumn("published_at", F.col("published_at").cast("timestamp"))
    sinks.write_parquet(frame, f"{root}/stored")
    read = [files.read_layer(spark, f"{root}/{name}", schema.TENDER).agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit(name).alias("layer"), "n") for name in ("stored", "missing")]
    return files.union_feeds(*read)


@query("latest_rows", _t("""
    SELECT id, tender_no, strftime(published_at, '%Y-%m-%d') AS published_at FROM tenders
    ORDER BY tenders.published_at DESC, id LIMIT 100"""))
def _(spark, sf_dir):
    return as_text(layers.latest(fx.tenders(spark, sf_dir), "published_at", "id").select("id", "tender_no", "published_at"),
                   published_at=DAY)


@query("parquet_write_modes", _t("""
    SELECT category, 2 * count(*) AS n FROM tenders GROUP BY category"""))
def _(spark, sf_dir):
    path, rows = scratch_path(spark, "modes"), fx.tenders(spark, sf_dir).select("id", "category")
    sinks.write_parquet(rows, path)
    stored = sinks.write_parquet(rows, path, "append")
    sinks.write_parquet(rows, path, "ignore")
    return files.read_parquet(spark, stored).groupBy("category").agg(F.count(F.lit(1)).alias("n"))


@query("lake_layer_runs", _t("""
    SELECT 'a' AS run_id, status, count(*) AS n FROM tenders GROUP BY status
    UNION ALL SELECT 'b', status, count(*) FROM tenders WHERE status <> 'P' GROUP BY status"""))
def _(spark, sf_dir):
    lake, rows = scratch_path(spark, "lake"), fx.tenders(spark, sf_dir).select("id", "status")
    sinks.write_lake_layer(rows, lake, "processed", "a")
    sinks.write_lake_layer(rows, lake, "processed", "b")
    # The repeated run replaces its own folder only.
    sinks.write_lake_layer(rows.where("status <> 'P'"), lake, "processed", "b")
    return files.read_parquet(spark, f"{lake}/processed").groupBy("run_id", "status").agg(F.count(F.lit(1)).alias("n"))


@query("table_write", _t("""
    SELECT category, count(*) AS n, round(sum(budget), 2) AS total_budget FROM tenders GROUP BY category"""))
def _(spark, sf_dir):
    name = f"tenders_{uuid.uuid4().hex}"
    sinks.write_table(fx.tenders(spark, sf_dir).select("category", "budget"), name, path=scratch_path(spark, "table"))
    found = rounded(spark.table(name).groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.sum("budget").alias("total_budget")))
    spark.sql(f"DROP TABLE {name}")  # the entry; the files are the owner's
    return found


@query("raw_load", fx.over("tenders", body="""
    SELECT 'RAW' AS stage, 'SUCCESS' AS status, count(*) AS records_count, count(*) AS stored, 'upload' AS load_source
    FROM tenders"""))
def _(spark, sf_dir):
    root = scratch_path(spark, "raw")
    frame = fx.tenders(spark, sf_dir).withColumn("published_at", F.col("published_at").cast("timestamp"))
    sinks.append_raw(frame, f"{root}/raw", f"{root}/log", "upload", CLOCK, "first")
    stored = files.read_layer(spark, f"{root}/raw", schema.RAW_LAYER).groupBy("run_id", "load_source") \
        .agg(F.count(F.lit(1)).alias("stored"))
    log = files.read_layer(spark, f"{root}/log", schema.ETL_LOG)
    return log.join(stored, "run_id") \
        .select("stage", "status", "records_count", "stored", "load_source")


@query("csv_export", _t("""
    SELECT status, count(*) AS count, round(sum(budget), 2) AS total_budget, true AS marked FROM tenders GROUP BY status"""))
def _(spark, sf_dir):
    grouped = rounded(aggregates.stats_by(fx.tenders(spark, sf_dir), ["status"], "budget", ["sum"], "budget"))
    path = sinks.write_csv(grouped, scratch_path(spark, "export"), byte_order_mark=True)
    files_ = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path)
    marked = files_.agg(F.bool_and(F.startswith("content", F.lit(b"\xef\xbb\xbf"))).alias("marked")).scalar()
    return files.read_csv(spark, path, "status string, count bigint, total_budget double").withColumn("marked", marked)


@query("results_export", _t("""
    SELECT f.format, category, count(*) AS count FROM tenders, (SELECT 'csv' AS format UNION ALL SELECT 'json') f
    GROUP BY f.format, category"""))
def _(spark, sf_dir):
    result = aggregates.value_counts(fx.tenders(spark, sf_dir), "category")
    json_path, csv_path = sinks.export_results(result, scratch_path(spark, "results"))
    form = "category string, count bigint"
    read = {"csv": files.read_csv(spark, csv_path, form), "json": files.read_json(spark, json_path, form)}
    return files.union_feeds(*[df.withColumn("format", F.lit(kind)) for kind, df in read.items()])


@query("table_sync", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def _(spark, sf_dir):
    path = sinks.sync_table(fx.table(spark, sf_dir, "orders"), scratch_path(spark, "sync"))
    return files.read_parquet(spark, path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("existing_columns", _t("SELECT category, id FROM tenders"))
def _(spark, sf_dir):
    return layers.existing(fx.tenders(spark, sf_dir), ["category", "no_such_column", "id"])


_SIZED = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents"]


@query("stored_bytes", " UNION ALL ".join(
    f"SELECT '{name}' AS name, count(*) AS rows, true AS has_files, true AS plausible FROM {name}" for name in _SIZED))
def _(spark, sf_dir):
    sizes = [layout.dataset_size(fx.table(spark, sf_dir, name)).select(
        F.lit(name).alias("name"), "rows", (F.col("files") > 0).alias("has_files"),
        (F.col("bytes") > F.col("rows")).alias("plausible")) for name in _SIZED]
    return files.union_feeds(*sizes)


@query("partition_rows", "SELECT count(*) AS rows, true AS numbered FROM lineitem")
def _(spark, sf_dir):
    parts = layout.partition_rows(fx.table(spark, sf_dir, "lineitem"))
    return parts.agg(F.sum("rows").alias("rows"), (F.count_distinct("partition") == F.count(F.lit(1))).alias("numbered"))


@query("batch_etl", _t("""
    SELECT category, region, count(*) AS count, CAST(sum(v) AS bigint) AS total_value, round(avg(v), 2) AS avg_value,
           max(v) AS max_value, min(v) AS min_value
    FROM (SELECT category, region, CAST(floor(budget) AS bigint) AS v FROM tenders) t GROUP BY category, region"""))
def _(spark, sf_dir):
    root = scratch_path(spark, "etl")
    record = T.StructType.fromDDL("id int, tender_name string, category string, region string, sum_value bigint, "
                                  "quantity int, date string, organization string, status string")
    source = sinks.write_csv(batch_etl.as_etl_frame(fx.tenders(spark, sf_dir)), f"{root}/in.csv")
    stored = batch_etl.run(spark, source, f"{root}/lake", "r1", schema=record)
    return rounded(files.read_parquet(spark, stored["aggregated"]).drop("run_id"))
