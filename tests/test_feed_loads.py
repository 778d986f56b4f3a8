"""What a load of a feed moves and sorts, and which copy of an item it takes."""

from datetime import date, datetime

from pyspark.sql import functions as F

from tenderlake import schema
from tenderlake.operators import layers
from tenderlake.plans import feed_ingest
from tenderlake.sources import feed, files

CLOCK = datetime(2024, 2, 1)
LINK = "https://e.org/?registrationNumber="


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def frame(spark, rows):
    return spark.createDataFrame(rows, "title string, link string, published string, description string").repartition(3)


def odd_items(spark):
    rows = [(f"t{k}", f"{LINK}{k}", "2024-01-02", "plain") for k in range(30)] * 2
    for k in range(5):
        rows += [(f"t{k}", f"{LINK}{k}", day, text) for day, text in (("2024-01-01", "b"), ("2024-01-01", "a"), ("soon", None))]
    # Copies of one version in which another field is missing.
    rows += [(None, f"{LINK}77", None, "x"), (None, f"{LINK}77", "x", None), ("", f"{LINK}77", "2024-01-05", "")]
    return frame(spark, rows)


def test_versions_are_counted_without_sorting_and_the_same_copy_is_taken(spark, rows, tmp_path):
    feed_ingest.numbered(feed.feed_versions(odd_items(spark), carry=True).drop("__text")).write.parquet(str(tmp_path / "items"))
    items = spark.read.parquet(str(tmp_path / "items"))
    versions = feed_ingest.counted_versions(items)
    assert "SortAggregate" not in plan(versions) and "ObjectHashAggregate" not in plan(versions)
    assert {r.tender_no: (r.n, r.alike) for r in versions.collect()} == {
        **{f"44-{k}": (2, True) for k in range(5, 30)}, **{f"44-{k}": (5, False) for k in range(5)}, "44-77": (3, False)}
    taken = feed_ingest.first_items(items, versions, True).select("tender_no", *feed_ingest.FIELDS)
    assert rows(taken) == rows(feed_ingest.single_versions(items).select("tender_no", *feed_ingest.FIELDS))
    alike = versions.where("alike")
    one = feed_ingest.first_items(items.join(alike, feed_ingest.VERSION, "left_semi"), alike, False)
    assert one.count() == 25 and "Aggregate" not in plan(one).split("BroadcastExchange")[0]


def test_a_load_takes_the_oldest_copy(spark, tmp_path):
    (tmp_path / "feed").mkdir()
    items = [("2024-01-03", "Регион: B"), ("2024-01-01", "Регион: A"), ("2024-01-03", "Регион: B")]
    (tmp_path / "feed" / "a.xml").write_text("<channel>" + "".join(
        f"<item><title>t</title><link>{LINK}1</link><published>{d}</published><description>{t}</description></item>"
        for d, t in items) + "</channel>")
    out = feed_ingest.run(spark, str(tmp_path / "feed"), str(tmp_path / "lake"), "feed", CLOCK, "r1")
    assert out == {"loaded": 1, "duplicate": 2, "error": 0, "processed": 1}
    row = spark.read.parquet(str(tmp_path / "lake" / "raw")).first()
    assert (row.region, row.published_at.date()) == ("A", date(2024, 1, 1))
    assert feed_ingest.registered(spark, str(tmp_path / "lake"), "feed").newest_item == date(2024, 1, 1)


def test_a_layer_that_is_not_there_costs_no_join(spark, tmp_path):
    items = feed.feed_versions(odd_items(spark))
    empty = files.read_layer(spark, str(tmp_path / "none"), schema.LEDGER)
    assert empty.schema == schema.LEDGER and empty.count() == 0
    text = plan(layers.not_loaded(items, feed_ingest.asked_versions(items, empty, files.read_layer(
        spark, str(tmp_path / "none"), schema.RAW_LAYER), [])))
    assert "Join" not in text


def test_known_items_are_left_out_before_versions_are_sorted(spark, rows, tmp_path):
    items = odd_items(spark)
    feed.feed_versions(items).where("tender_no < '44-2'").select("tender_no", "content_hash").write.parquet(str(tmp_path / "known"))
    known = spark.read.parquet(str(tmp_path / "known"))
    fresh = feed_ingest.new_records(items, known, "feed", CLOCK)
    text = fresh._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("Aggregate [content_hash") < text.index("Join LeftAnti")
    want = layers.not_loaded(feed_ingest.single_versions(feed.feed_versions(items)), known)
    assert rows(fresh.select("tender_no", "url", "raw_description")) == rows(want.select("tender_no", "link", "description"))


def test_single_items_are_cut_as_the_pattern_cuts(spark, tmp_path):
    whole = "<title>{0}</title><link>l{0}</link>"
    pieces = ["<channel>\n<item>" + whole.format("a"), "<item kind='x'>" + whole.format("b"), "<item>broken<item>" + whole.format("c"),
              "<item\n>" + whole.format("d"), "<item><items>1</items>" + whole.format("e"), "<!-- <item> --><item>" + whole.format("f"),
              "<item><title><![CDATA[<item>]]></title><link>lg</link>", "no item", "<items><item>" + whole.format("h"), "<item>" * 2 + whole.format("i")]
    (tmp_path / "a.xml").write_text("</item>".join(pieces) + "</item></channel>")
    read = feed.read_feed(spark, str(tmp_path))
    got = sorted(r.link for r in read.where("faulty IS NULL").collect())
    assert got == ["la", "lb", "lc", "ld", "le", "lf", "lg", "lh", "li"]
    assert sorted(r.faulty for r in read.where("faulty IS NOT NULL").collect()) == ["<item>", "<item>broken"]
    assert plan(read).count("regexp_extract_all") >= 1 and "CASE WHEN" in plan(read)
