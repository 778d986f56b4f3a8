"""Daily series, trend summaries and load monitoring."""

from datetime import date

from pyspark.sql import functions as F

from tenderlake import sinks
from tenderlake.catalog import fixtures as fx
from tenderlake.catalog.registry import DAY, SECOND, as_text, query, rounded
from tenderlake.operators import filters, layers, trends
from tenderlake.plans import trend_report
from tenderlake.session import scratch_path
from tenderlake.sources import files


def _t(body: str) -> str:
    return fx.over("tenders", body=body)


def _l(body: str) -> str:
    return fx.over("load_log", body=body)


_DAY = "strftime(published_at, '%Y-%m-%d') AS day"
_NEWEST = "(SELECT max(logged_at) FROM load_log)"


@query("daily_budget", _t(f"SELECT {_DAY}, round(sum(budget), 2) AS total_budget FROM tenders GROUP BY day"))
def _(spark, sf_dir):
    return as_text(rounded(trends.daily_sum(fx.tenders(spark, sf_dir))), day=DAY)


@query("daily_count", _t(f"SELECT {_DAY}, count(*) AS count FROM tenders GROUP BY day"))
def _(spark, sf_dir):
    return as_text(trends.daily_count(fx.tenders(spark, sf_dir)), day=DAY)


for _by in ("category", "region"):
    @query(f"daily_budget_by_{_by}", _t(f"""
        SELECT {_DAY}, {_by}, round(sum(budget), 2) AS total_budget FROM tenders GROUP BY day, {_by}"""))
    def _(spark, sf_dir, by=_by):
        return as_text(rounded(trends.daily_sum(fx.tenders(spark, sf_dir), by)), day=DAY)


@query("tenders_by_date", _t("""
    SELECT id, strftime(published_at, '%Y-%m-%d') AS published_at, row_number() OVER (ORDER BY tenders.published_at, id) AS position
    FROM tenders"""))
def _(spark, sf_dir):
    from tenderlake.operators.ranking import row_number_by

    dated = fx.tenders(spark, sf_dir).select("id", "published_at")
    return as_text(row_number_by(dated, [], ["published_at", "id"], "position"), published_at=DAY)


_SELECTED = "SELECT * FROM tenders WHERE category IN ('BUILDING', 'MACHINERY')"


@query("trend_summary", _t(f"""
    WITH daily AS (SELECT CAST(published_at AS date) AS day, sum(budget) AS v FROM ({_SELECTED}) s
                   WHERE region IN (SELECT n_name FROM nation) GROUP BY 1)
    SELECT count(*) AS periods, round(max(v), 2) AS max_total, round(min(v), 2) AS min_total,
           round((arg_max(v, day) - arg_min(v, day)) * 100 / arg_min(v, day), 4) AS change_pct FROM daily"""))
def _(spark, sf_dir):
    regions = fx.table(spark, sf_dir, "nation").select("n_name")
    report = trend_report.report(fx.tenders(spark, sf_dir), ["BUILDING", "MACHINERY"], regions)
    return report["summary"].withColumns({"max_total": F.round("max_total", 2), "min_total": F.round("min_total", 2),
                                          "change_pct": F.round("change_pct", 4)})


@query("trend_by_category", _t(f"""
    SELECT {_DAY}, category, round(sum(budget), 2) AS total_budget FROM ({_SELECTED}) s
    WHERE region IN (SELECT n_name FROM nation ORDER BY n_name LIMIT 5) GROUP BY day, category"""))
def _(spark, sf_dir):
    regions = fx.table(spark, sf_dir, "nation").select("n_name").orderBy("n_name").limit(5)
    report = trend_report.report(fx.tenders(spark, sf_dir), ["BUILDING", "MACHINERY"], regions)
    return as_text(rounded(report["by_category"]), day=DAY)


@query("loads_within_day", _l(f"""
    SELECT id, source, stage FROM load_log WHERE logged_at > {_NEWEST} - INTERVAL 24 HOUR"""))
def _(spark, sf_dir):
    return filters.loaded_within(fx.load_log(spark, sf_dir), "logged_at", 24).select("id", "source", "stage")


@query("ledger_retention", fx.over("ledger", body="""
    SELECT tender_no, strftime(loaded_at, '%Y-%m-%d') AS loaded_at FROM ledger
    WHERE ledger.loaded_at >= (SELECT max(loaded_at) FROM ledger) - INTERVAL 7 DAY"""))
def _(spark, sf_dir):
    kept = filters.retained(fx.ledger(spark, sf_dir), "loaded_at", 7)
    return as_text(kept.select("tender_no", "loaded_at"), loaded_at=DAY)


@query("ledger_by_month", fx.over("ledger", body="""
    SELECT tender_no, strftime(loaded_at, '%Y-%m-%d') AS loaded_at FROM ledger
    WHERE ledger.loaded_at >= date_trunc('month', (SELECT max(loaded_at) FROM ledger))"""))
def _(spark, sf_dir):
    """The ledger in folders of months; retention drops whole folders."""
    path = scratch_path(spark, "ledger-months")
    rows = fx.ledger(spark, sf_dir)
    sinks.write_by_day(rows, path, "loaded_at", "month")
    sinks.drop_days(spark, path, rows.agg(F.max("loaded_at")).first()[0].date().replace(day=1))
    return as_text(spark.read.parquet(path).select("tender_no", "loaded_at"), loaded_at=DAY)


@query("newer_than_mark", fx.over("feed_items", body="""
    SELECT item_id FROM feed_items
    WHERE published = 'soon' OR item_id IN (SELECT id FROM tenders WHERE published_at > TIMESTAMP '2000-06-15')"""))
def _(spark, sf_dir):
    from tenderlake.functions import dates

    dated = fx.feed_items(spark, sf_dir).withColumn("published_on", dates.feed_date("published"))
    return filters.newer_than(dated, "published_on", date(2000, 6, 15)).select("item_id")


@query("hourly_loads", _l(f"""
    SELECT strftime(logged_at, '%Y-%m-%d') AS day, CAST(hour(logged_at) AS integer) AS hour, count(*) AS count
    FROM load_log WHERE logged_at > {_NEWEST} - INTERVAL 24 HOUR GROUP BY day, hour"""))
def _(spark, sf_dir):
    return as_text(trends.hourly_loads(fx.load_log(spark, sf_dir)), day=DAY)


@query("loads_per_day", _l("SELECT strftime(logged_at, '%Y-%m-%d') AS day, count(*) AS count FROM load_log GROUP BY day"))
def _(spark, sf_dir):
    return as_text(trends.loads_per_day(fx.load_log(spark, sf_dir)), day=DAY)


@query("log_success", _l("""
    SELECT count(*) AS total, count(*) FILTER (WHERE lower(status) = 'success') AS success_count,
           count(*) FILTER (WHERE lower(status) = 'error') AS error_count,
           round(100.0 * count(*) FILTER (WHERE lower(status) = 'success') / count(*), 4) AS success_pct
    FROM load_log"""))
def _(spark, sf_dir):
    return rounded(trends.log_success(fx.load_log(spark, sf_dir)), 4)


@query("last_loads", _l("""
    SELECT source, strftime(max(logged_at), '%Y-%m-%d %H:%M:%S') AS last_load_time FROM load_log GROUP BY source"""))
def _(spark, sf_dir):
    return as_text(trends.last_loads(fx.load_log(spark, sf_dir), "source", "logged_at"), last_load_time=SECOND)


@query("rolling_load_stats", _l(f"""
    SELECT source, count(*) AS total_loads,
           count(*) FILTER (WHERE logged_at > {_NEWEST} - INTERVAL 1 HOUR) AS recent_loads,
           strftime(max(logged_at), '%Y-%m-%d %H:%M:%S') AS last_load_time FROM load_log GROUP BY source"""))
def _(spark, sf_dir):
    return as_text(trends.rolling_load_stats(fx.load_log(spark, sf_dir)), last_load_time=SECOND)


@query("load_repeats", f"""
    SELECT CAST(count(*) AS bigint) AS loads, CAST(count(*) - count(DISTINCT user_id) AS bigint) AS repeats FROM events
    WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 48 HOUR""")
def _(spark, sf_dir):
    return trends.load_counts(fx.table(spark, sf_dir, "events"), ["user_id"], "ts", 48)


@query("latest_log_rows", _l("""
    SELECT stage, status, records_count, strftime(logged_at, '%Y-%m-%d %H:%M:%S') AS logged_at FROM load_log
    ORDER BY load_log.logged_at DESC, id LIMIT 10"""))
def _(spark, sf_dir):
    rows = layers.latest(fx.load_log(spark, sf_dir), "logged_at", "id", 10)
    return as_text(rows.select("stage", "status", "records_count", "logged_at"), logged_at=SECOND)


_LINE = """SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS logged_at,
                  CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'view' THEN 'WARNING' ELSE 'INFO' END AS level,
                  event_id FROM events"""


@query("log_lines_by_level", f"""
    SELECT logged_at, level, concat(logged_at, ' - loader - ', level, ' - event ', CAST(event_id AS string)) AS line
    FROM ({_LINE}) l WHERE level = 'ERROR' ORDER BY logged_at DESC, line DESC LIMIT 50""")
def _(spark, sf_dir):
    level = F.when(F.col("event_type") == "error", "ERROR").when(F.col("event_type") == "view", "WARNING").otherwise("INFO")
    lines = fx.table(spark, sf_dir, "events").select(F.concat(
        F.date_format("ts", SECOND), F.lit(" - loader - "), level, F.lit(" - event "),
        F.col("event_id").cast("string")).alias("value"))
    path = scratch_path(spark, "logs")
    lines.write.text(path)
    return trends.log_lines(files.read_log(spark, path), "ERROR", 50)
