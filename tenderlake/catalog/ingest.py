"""Feed extraction, layers, ledger and registry."""

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from tenderlake import schema
from tenderlake.catalog import fixtures as fx
from tenderlake.catalog.registry import DAY, as_text, query, rounded
from tenderlake.functions import dates, text
from tenderlake.operators import layers, ledger
from tenderlake.plans import feed_ingest
from tenderlake.session import durable, scratch_path
from tenderlake.sources import feed, files

CLOCK = datetime(2024, 2, 1, 12, 0)

_CATEGORY = """CASE item_id % 5 WHEN 0 THEN 'Транспорт' WHEN 1 THEN 'IT' WHEN 2 THEN 'Образование'
                               WHEN 3 THEN 'Благоустройство' ELSE 'Не указана' END"""
# The SQL side cuts the fields out of the description with its own patterns.
_RECORDS = r"""
    SELECT concat('44-', regexp_extract(link, 'registrationNumber=([^&]+)', 1)) AS tender_no,
           substr(trim(regexp_extract(description, 'Заказчик:\s*([^\n<]+)', 1)), 1, 100) AS organization,
           substr(title, 1, 200) AS description, CATEGORY AS category,
           substr(trim(regexp_extract(description, 'Регион:\s*([^\n<]+)', 1)), 1, 50) AS region,
           coalesce(try_cast(replace(regexp_extract(description, 'Начальная[^:]*:\s*([0-9,.]+)', 1), ',', '.') AS double), 0) AS budget,
           'Объявлена' AS status,
           strftime(coalesce(try_strptime(substr(published, 6, 20), '%d %b %Y %H:%M:%S'),
                    try_strptime(published, '%Y-%m-%dT%H:%M:%S'), try_strptime(published, '%Y-%m-%d')), '%Y-%m-%d') AS published_on,
           link AS url
    FROM feed_items""".replace("CATEGORY", _CATEGORY)
_FIELDS = ["tender_no", "organization", "description", "category", "region", "budget", "status", "published_on", "url"]


def _f(body: str) -> str:
    return fx.over("feed_items", body=body)


@query("feed_records", _f(_RECORDS))
def _(spark, sf_dir):
    records = feed.feed_records(fx.feed_items(spark, sf_dir), "feed", CLOCK, cut=True)
    return as_text(rounded(records.select(_FIELDS)), published_on=DAY)


@query("feed_labels", _f(r"""
    SELECT item_id, trim(regexp_extract(description, 'Заказчик:\s*([^\n<]+)', 1)) AS organization,
           trim(regexp_extract(description, 'Регион:\s*([^\n<]+)', 1)) AS region FROM feed_items"""))
def _(spark, sf_dir):
    visible = fx.feed_items(spark, sf_dir).select("item_id", text.strip_tags("description").alias("t"))
    return visible.select(
        "item_id", text.labelled_value("t", text.CUSTOMER_LABEL, text.CUSTOMER_MAX).alias("organization"),
        text.labelled_value("t", text.REGION_LABEL, text.REGION_MAX).alias("region"))


@query("feed_categories", _f(f"SELECT item_id, {_CATEGORY} AS category FROM feed_items"))
def _(spark, sf_dir):
    lowered = fx.feed_items(spark, sf_dir).select("item_id", F.lower("description").alias("t"))
    return lowered.select("item_id", text.classify("t").alias("category"))


@query("feed_prices", fx.over("tenders", body="""
    SELECT id AS item_id, CASE WHEN id % 41 = 0 THEN 0 ELSE round(budget, 2) END AS price FROM tenders"""))
def _(spark, sf_dir):
    return rounded(fx.feed_items(spark, sf_dir).select(
        "item_id", text.labelled_price(text.strip_tags("description")).alias("price")))


@query("feed_dates", fx.over("tenders", body="""
    SELECT id AS item_id, CASE WHEN id % 4 = 3 THEN NULL ELSE strftime(published_at, '%Y-%m-%d') END AS published_on
    FROM tenders"""))
def _(spark, sf_dir):
    return as_text(fx.feed_items(spark, sf_dir).select("item_id", dates.feed_date("published").alias("published_on")),
                   published_on=DAY)


@query("feed_numbers", _f("""
    SELECT item_id, concat('44-', CAST(item_id AS string)) AS tender_no, concat('44-', md5(title)) AS fallback_no,
           concat('44-', md5(concat(title, chr(31), published, chr(31), CAST(item_id AS string)))) AS linkless_no
    FROM feed_items"""))
def _(spark, sf_dir):
    return fx.feed_items(spark, sf_dir).select("item_id", text.purchase_number("link").alias("tender_no"),
                                               text.purchase_number("title").alias("fallback_no"),
                                               text.purchase_number(F.lit(""), "title", "published",
                                                                    F.col("item_id").cast("string")).alias("linkless_no"))


@query("feed_xml_scan", _f("SELECT title, link, published, description FROM feed_items"))
def _(spark, sf_dir):
    path = scratch_path(spark, "feed")
    fx.feed_items(spark, sf_dir).select("title", "link", "published", "description").write \
        .format("xml").option("rootTag", "channel").option("rowTag", feed.ITEM_TAG).save(path)
    return feed.read_feed(spark, path).drop("faulty")


@query("feed_first_items", _f("""
    SELECT link, title FROM feed_items ORDER BY
      coalesce(try_strptime(substr(published, 6, 20), '%d %b %Y %H:%M:%S'), try_strptime(published, '%Y-%m-%dT%H:%M:%S'),
               try_strptime(published, '%Y-%m-%d'))::date DESC NULLS LAST, link, title LIMIT 100"""))
def _(spark, sf_dir):
    return feed.newest(fx.feed_items(spark, sf_dir), 100).select("link", "title")


@query("union_feeds", _f("""
    SELECT title, link, CAST(NULL AS string) AS published, count(*) AS n FROM feed_items GROUP BY title, link
    UNION ALL SELECT title, link, published, count(*) AS n FROM feed_items GROUP BY title, link, published"""))
def _(spark, sf_dir):
    items = fx.feed_items(spark, sf_dir)
    both = files.union_feeds(items.select("title", "link", "published"), items.select("title", "link"))
    return both.groupBy("title", "link", "published").agg(F.count(F.lit(1)).alias("n"))


@query("content_hashes", fx.over("tenders", body="""
    SELECT id, md5(concat(tender_no, description, CAST(CAST(budget AS decimal(20,2)) AS string))) AS content_hash
    FROM tenders"""))
def _(spark, sf_dir):
    return layers.with_content_hash(fx.tenders(spark, sf_dir)).select("id", "content_hash")


_HASHED = """hashed AS (SELECT *, md5(concat(tender_no, description, CAST(CAST(budget AS decimal(20,2)) AS string))) AS content_hash
                       FROM tenders)"""


@query("not_loaded", fx.over("ledger", body=f"""WITH {_HASHED}
    SELECT id, tender_no, content_hash FROM hashed h WHERE NOT EXISTS (
      SELECT 1 FROM ledger l WHERE l.tender_no = h.tender_no AND l.content_hash = h.content_hash)"""))
def _(spark, sf_dir):
    return layers.not_loaded(layers.with_content_hash(fx.tenders(spark, sf_dir)), fx.ledger(spark, sf_dir)) \
        .select("id", "tender_no", "content_hash")


@query("already_loaded", fx.over("ledger", body=f"""WITH {_HASHED}
    SELECT id, tender_no FROM hashed h WHERE EXISTS (
      SELECT 1 FROM ledger l WHERE l.tender_no = h.tender_no AND l.content_hash = h.content_hash)"""))
def _(spark, sf_dir):
    return layers.already_loaded(layers.with_content_hash(fx.tenders(spark, sf_dir)), fx.ledger(spark, sf_dir)) \
        .select("id", "tender_no")


@query("ledger_lookup", fx.over("ledger", body=f"""WITH {_HASHED}
    SELECT id, tender_no, EXISTS (SELECT 1 FROM ledger l WHERE l.tender_no = h.tender_no AND l.content_hash = h.content_hash) AS known
    FROM hashed h"""))
def _(spark, sf_dir):
    """All tenders against a ledger in buckets, which two loads have filled."""
    name = f"ledger_{uuid.uuid4().hex}"
    ledger.open_ledger(spark, name, scratch_path(spark, "ledger-buckets"), 16)
    loaded = fx.ledger(spark, sf_dir)
    late = F.pmod(F.xxhash64("tender_no"), F.lit(2)) == 0
    for run, rows in (("r1", loaded.where(late)), ("r2", loaded.where(~late))):
        ledger.enter(rows, name, "feed", CLOCK, run, 16)
    batch = layers.with_content_hash(fx.tenders(spark, sf_dir))
    found = ledger.known(batch, spark.table(name)).select("version", F.lit(True).alias("known"))
    marked = batch.withColumn("version", ledger.version()).join(found, "version", "left")
    return marked.select("id", "tender_no", F.coalesce("known", F.lit(False)).alias("known"))


@query("load_outcome", fx.over("ledger", body=f"""WITH {_HASHED},
    batch AS (SELECT CASE WHEN id % 101 = 0 THEN NULL ELSE tender_no END AS tender_no, content_hash FROM hashed
              UNION ALL SELECT tender_no, content_hash FROM hashed),
    keyed AS (SELECT b.tender_no, b.content_hash, count(*) AS n,
                     bool_or(EXISTS (SELECT 1 FROM ledger l WHERE l.tender_no = b.tender_no
                                     AND l.content_hash = b.content_hash)) AS known
              FROM batch b GROUP BY 1, 2)
    SELECT count(*) FILTER (WHERE tender_no IS NOT NULL AND NOT known) AS loaded_count,
           CAST(sum(CASE WHEN tender_no IS NULL THEN 0 WHEN known THEN n ELSE n - 1 END) AS bigint) AS duplicate_count,
           CAST(sum(CASE WHEN tender_no IS NULL THEN n ELSE 0 END) AS bigint) AS error_count FROM keyed"""))
def _(spark, sf_dir):
    hashed = layers.with_content_hash(fx.tenders(spark, sf_dir)).select("id", "tender_no", "content_hash")
    faulty = hashed.withColumn("tender_no", F.when(F.col("id") % 101 != 0, F.col("tender_no")))
    return layers.load_outcome(faulty.unionByName(hashed), fx.ledger(spark, sf_dir))


@query("insert_or_ignore", fx.over("dirty_tenders", body="""
    SELECT organization, min(id) AS id FROM dirty_tenders
    WHERE organization NOT IN (SELECT c_name FROM customer WHERE c_acctbal < 0) GROUP BY organization"""))
def _(spark, sf_dir):
    target = fx.table(spark, sf_dir, "customer").where("c_acctbal < 0").select(F.col("c_name").alias("organization"))
    fresh = layers.insert_or_ignore(fx.dirty_tenders(spark, sf_dir), target, "organization", ["id"])
    return fresh.select("organization", "id")


@query("unprocessed_rows", fx.over("processed", body="""
    SELECT id, tender_no FROM tenders WHERE id NOT IN (SELECT raw_id FROM processed WHERE raw_id IS NOT NULL)"""))
def _(spark, sf_dir):
    return layers.unprocessed(fx.tenders(spark, sf_dir), fx.processed(spark, sf_dir)).select("id", "tender_no")


_PROMOTED = """
    SELECT tender_no, category, round(budget, 2) AS budget, round(budget / 1000000, 8) AS budget_mln, region,
           CAST(month(published_at) AS integer) AS month, CAST(quarter(published_at) AS integer) AS quarter,
           '2024-02-01' AS processed_at, id AS raw_id FROM tenders"""


def _promoted(df):
    return as_text(df.withColumns({"budget": F.round("budget", 2), "budget_mln": F.round("budget_mln", 8)}),
                   processed_at=DAY)


@query("promote_increment", fx.over("processed", body=f"""
    {_PROMOTED} WHERE id NOT IN (SELECT raw_id FROM processed WHERE raw_id IS NOT NULL)"""))
def _(spark, sf_dir):
    return _promoted(layers.promote(fx.tenders(spark, sf_dir), fx.processed(spark, sf_dir), CLOCK))


@query("layer_union", fx.over("processed", body="""
    SELECT raw_id, tender_no, month FROM processed
    UNION ALL SELECT id, tender_no, CAST(month(published_at) AS integer) FROM tenders
    WHERE id NOT IN (SELECT raw_id FROM processed WHERE raw_id IS NOT NULL)"""))
def _(spark, sf_dir):
    done = fx.processed(spark, sf_dir)
    fresh = layers.promote(fx.tenders(spark, sf_dir), done, CLOCK)
    return done.unionByName(fresh, allowMissingColumns=True).select("raw_id", "tender_no", "month")


@query("lineage", fx.over("processed", body="""
    SELECT p.raw_id, p.tender_no, t.organization, t.source FROM processed p JOIN tenders t ON p.raw_id = t.id"""))
def _(spark, sf_dir):
    return layers.lineage(fx.processed(spark, sf_dir), fx.tenders(spark, sf_dir)) \
        .select("raw_id", "tender_no", "organization", "source")


for _by in ("category", "region", "month"):
    @query(f"processing_stats_{_by}", fx.over("processed", body=f"""
        SELECT {_by}, count(*) AS count, round(sum(budget_mln), 8) AS total_budget FROM processed GROUP BY {_by}"""))
    def _(spark, sf_dir, by=_by):
        return rounded(layers.stats_of(fx.processed(spark, sf_dir), by), 8)


@query("processing_stats", fx.over("processed", body="""
    SELECT 'category' AS dimension, category AS value, count(*) AS count, round(sum(budget_mln), 8) AS total_budget
    FROM processed GROUP BY category
    UNION ALL SELECT 'region', region, count(*), round(sum(budget_mln), 8) FROM processed GROUP BY region
    UNION ALL SELECT 'month', CAST(month AS string), count(*), round(sum(budget_mln), 8) FROM processed GROUP BY month"""))
def _(spark, sf_dir):
    return rounded(layers.processing_stats(fx.processed(spark, sf_dir)), 8)


@query("layer_counts", fx.over("processed", body="""
    SELECT (SELECT count(*) FROM tenders) AS raw_count, (SELECT count(*) FROM processed) AS processed_count,
           round(100.0 * (SELECT count(*) FROM processed) / (SELECT count(*) FROM tenders), 4) AS processed_pct"""))
def _(spark, sf_dir):
    return rounded(layers.layer_counts(fx.tenders(spark, sf_dir), fx.processed(spark, sf_dir)), 4)


@query("source_registry", fx.over("tenders", body="""
    WITH both_rows AS (
      SELECT r_name AS name, TIMESTAMP '1990-01-01' AS last_load_time, 0 AS last_load_count FROM region
      UNION ALL SELECT source, max(published_at), count(*) FROM tenders WHERE category <> 'BUILDING' GROUP BY source
      UNION ALL SELECT category, max(published_at), count(*) FROM tenders GROUP BY category)
    SELECT name, strftime(max(last_load_time), '%Y-%m-%d') AS last_load_time,
           arg_max(last_load_count, last_load_time) AS last_load_count FROM both_rows GROUP BY name"""))
def _(spark, sf_dir):
    registry = fx.table(spark, sf_dir, "region").select(
        F.col("r_name").alias("name"), F.lit("1990-01-01").cast("timestamp_ntz").alias("last_load_time"),
        F.lit(0).cast("bigint").alias("last_load_count"))
    rows = fx.tenders(spark, sf_dir)

    def loads(df, name):
        return df.groupBy(F.col(name).alias("name")).agg(
            F.max("published_at").alias("last_load_time"), F.count(F.lit(1)).alias("last_load_count"))

    updates = loads(rows.where("category <> 'BUILDING'"), "source").unionByName(loads(rows, "category"))
    return as_text(layers.source_stats(layers.upsert_sources(registry, updates)), last_load_time=DAY)


@query("feed_ingest", _f(f"""WITH records AS ({_RECORDS}),
    hashed AS (SELECT *, md5(concat(tender_no, description, CAST(CAST(budget AS decimal(20,2)) AS string))) AS content_hash
               FROM records),
    known AS (SELECT tender_no, content_hash FROM hashed WHERE category = 'IT')
    SELECT tender_no, organization, category, region, round(budget / 1000000, 8) AS budget_mln, content_hash,
           CAST(month(CAST(published_on AS date)) AS integer) AS month
    FROM hashed WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.tender_no = hashed.tender_no
                                  AND k.content_hash = hashed.content_hash)"""))
def _(spark, sf_dir):
    items = fx.feed_items(spark, sf_dir)
    known = durable(feed.feed_versions(items.where(F.contains("description", F.lit("сервер"))))
                    .select("tender_no", "content_hash"))
    # Every item arrives twice; one row per version survives.
    fresh = feed_ingest.new_records(items.unionByName(items), known, "feed", CLOCK)
    return fresh.select("tender_no", "organization", "category", "region",
                        F.round(F.col("budget") / 1_000_000, 8).alias("budget_mln"), "content_hash",
                        F.month("published_on").alias("month"))


@query("feed_loads", fx.over("feed_items", body="""
    SELECT 'first' AS run, count(*) FILTER (WHERE item_id % 2 = 0) AS loaded,
           count(*) FILTER (WHERE item_id % 6 = 0) AS duplicate, count(*) FILTER (WHERE item_id % 10 = 0) AS error,
           count(*) FILTER (WHERE item_id % 2 = 0) AS processed FROM feed_items
    UNION ALL
    SELECT 'second', count(*) FILTER (WHERE item_id % 2 = 1),
           count(*) FILTER (WHERE item_id % 2 = 0) + count(*) FILTER (WHERE item_id % 6 = 0),
           count(*) FILTER (WHERE item_id % 10 = 0), count(*) FILTER (WHERE item_id % 2 = 1) FROM feed_items
    UNION ALL SELECT 'lake', count(*), count(*), 0, count(*) FROM feed_items"""))
def _(spark, sf_dir):
    """The whole job, twice: half of the items with copies and malformed ones, then the others too."""
    root = scratch_path(spark, "feed-loads")
    escaped = lambda c: F.replace(F.replace(F.col(c), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    fields = [F.concat(F.lit(f"<{c}>"), escaped(c), F.lit(f"</{c}>")) for c in ("title", "link", "published", "description")]
    items = fx.feed_items(spark, sf_dir).select("item_id", F.concat(F.lit("<item>"), *fields, F.lit("</item>")).alias("value"))
    even = items.where("item_id % 2 = 0")
    faulty = items.where("item_id % 10 = 0").select("item_id", F.lit("<item><title>cut off</item>").alias("value"))
    land = even.unionByName(items.where("item_id % 6 = 0")).unionByName(faulty)
    land.select("value").write.text(f"{root}/feed/a")
    outcomes = [("first", feed_ingest.run(spark, f"{root}/feed/*", f"{root}/lake", "feed", CLOCK, "r1"))]
    items.where("item_id % 2 = 1").select("value").write.text(f"{root}/feed/b")
    outcomes.append(("second", feed_ingest.run(spark, f"{root}/feed/*", f"{root}/lake", "feed", CLOCK, "r2")))
    counts = {name: files.read_layer(spark, f"{root}/lake/{name}", record).count() for name, record in
              (("raw", schema.RAW_LAYER), ("ledger", schema.LEDGER), ("processed", schema.PROCESSED_LAYER))}
    outcomes.append(("lake", {"loaded": counts["raw"], "duplicate": counts["ledger"], "error": 0,
                              "processed": counts["processed"]}))
    return spark.createDataFrame([(run, *(o[k] for k in ("loaded", "duplicate", "error", "processed"))) for run, o in outcomes],
                                 "run string, loaded long, duplicate long, error long, processed long")


def _landed(items):
    escaped = lambda c: F.replace(F.replace(F.col(c), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    fields = [F.concat(F.lit(f"<{c}>"), escaped(c), F.lit(f"</{c}>")) for c in ("title", "link", "published", "description")]
    return items.select("item_id", F.concat(F.lit("<item>"), *fields).alias("value"))


@query("feed_unclosed_items", _f("SELECT title, link, published, description FROM feed_items WHERE item_id % 10 <> 3"))
def _(spark, sf_dir):
    """Every tenth item breaks off in its description; it costs itself, not the item behind it."""
    path, whole = scratch_path(spark, "feed-unclosed"), F.concat("value", F.lit("</item><!-- <item> -->"))
    broken = F.replace("value", F.lit("</description>"), F.lit(""))
    _landed(fx.feed_items(spark, sf_dir)).select(F.when(F.col("item_id") % 10 != 3, whole).otherwise(broken).alias("value")) \
        .write.text(path)
    return feed.read_feed(spark, path).where("faulty IS NULL").drop("faulty")


@query("feed_backlog", _f("""
    SELECT concat('44-', regexp_extract(link, 'registrationNumber=([^&]+)', 1)) AS tender_no, 1 AS times FROM feed_items"""))
def _(spark, sf_dir):
    """Limited loads from the mark of the load before, until one finds nothing: every item is loaded, once."""
    root, items = scratch_path(spark, "feed-backlog"), fx.feed_items(spark, sf_dir)
    _landed(items).select(F.concat("value", F.lit("</item>")).alias("value")).write.text(f"{root}/feed")
    third, run, loaded = -(-items.count() // 3), 0, None
    while loaded != 0:
        run += 1
        loaded = feed_ingest.run(spark, f"{root}/feed", f"{root}/lake", "feed", CLOCK, f"r{run}", limit=third,
                                 since=feed_ingest.last_load(spark, f"{root}/lake", "feed"))["loaded"]
    raw = files.read_layer(spark, f"{root}/lake/raw", schema.RAW_LAYER)
    return raw.groupBy("tender_no").agg(F.count(F.lit(1)).cast("int").alias("times"))
