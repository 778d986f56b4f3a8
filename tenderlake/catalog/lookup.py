"""Filters, keyword search, facets and similarity search."""

from pyspark.sql import functions as F

from tenderlake.catalog import fixtures as fx
from tenderlake.catalog.registry import DAY, as_text, query, rounded
from tenderlake.functions import text
from tenderlake.operators import aggregates, filters, search, similarity
from tenderlake.plans import search_page


def _t(body: str) -> str:
    return fx.over("tenders", body=body)


_RESULT = ("tender_no, organization, description, category, region, round(budget, 2) AS budget, status, "
           "strftime(published_at, '%Y-%m-%d') AS published_at")
_DEAREST = "SELECT id, category, region, organization, round(budget, 2) AS budget FROM tenders"


def _shown(df):
    return as_text(rounded(df), published_at=DAY)


def _dear(df):
    return rounded(df.select("id", "category", "region", "organization", "budget"))


@query("filter_by_values", _t("""
    SELECT id, category, status FROM tenders WHERE category IN ('BUILDING', 'MACHINERY') AND status = 'F'"""))
def _(spark, sf_dir):
    wanted = {"category": ["BUILDING", "MACHINERY"], "status": "F", "no_such_column": 1}
    return filters.where_values(fx.tenders(spark, sf_dir), wanted).select("id", "category", "status")


@query("above_threshold", _t("""
    SELECT id, category, region, round(budget, 2) AS budget FROM tenders WHERE budget > 400000"""))
def _(spark, sf_dir):
    return rounded(filters.above_budget(fx.tenders(spark, sf_dir), 400_000.0, ["id", "category", "region", "budget"]))


@query("filter_by_category", _t(f"{_DEAREST} WHERE lower(category) = 'building' ORDER BY budget DESC, id LIMIT 100"))
def _(spark, sf_dir):
    return _dear(filters.by_category(fx.tenders(spark, sf_dir), "Building"))


@query("filter_by_region", _t(f"{_DEAREST} WHERE lower(region) = lower('nation_3') ORDER BY budget DESC, id LIMIT 100"))
def _(spark, sf_dir):
    return _dear(filters.by_region(fx.tenders(spark, sf_dir), "Nation_3"))


@query("filter_by_budget", _t(f"{_DEAREST} WHERE budget BETWEEN 100000 AND 300000 ORDER BY budget DESC, id LIMIT 100"))
def _(spark, sf_dir):
    return _dear(filters.by_budget(fx.tenders(spark, sf_dir), 100_000.0, 300_000.0))


@query("filter_by_organization", _t(f"""
    {_DEAREST} WHERE contains(lower(organization), 'customer#00000001') ORDER BY budget DESC, id LIMIT 100"""))
def _(spark, sf_dir):
    return _dear(filters.by_organization(fx.tenders(spark, sf_dir), "CUSTOMER#00000001"))


@query("match_selection", _t("""
    SELECT id, round(budget, 2) AS budget FROM tenders
    WHERE category = 'BUILDING' AND region = (SELECT min(n_name) FROM nation) AND status = 'F'
      AND budget BETWEEN 50000 AND 450000"""))
def _(spark, sf_dir):
    region = fx.table(spark, sf_dir, "nation").agg(F.min("n_name")).first()[0]
    return rounded(filters.matches_selection(fx.tenders(spark, sf_dir), "BUILDING", region, "F", 50_000.0, 450_000.0)
                   .select("id", "budget"))


@query("multi_select", _t("""
    SELECT id, category, region FROM tenders WHERE category IN ('BUILDING', 'AUTOMOBILE')
      AND region IN (SELECT n_name FROM nation ORDER BY n_name LIMIT 2)"""))
def _(spark, sf_dir):
    regions = [r[0] for r in fx.table(spark, sf_dir, "nation").select("n_name").orderBy("n_name").limit(2).collect()]
    return filters.in_selections(fx.tenders(spark, sf_dir), ["BUILDING", "AUTOMOBILE"], regions) \
        .select("id", "category", "region")


@query("positive_budget", fx.over("dirty_tenders", body="""
    SELECT id, budget FROM dirty_tenders WHERE budget IS NOT NULL AND budget > 0"""))
def _(spark, sf_dir):
    return filters.with_positive(fx.dirty_tenders(spark, sf_dir), "budget").select("id", "budget")


_HIT = " OR ".join(f"contains(lower({c}), '%s')" for c in
                   ("tender_no", "organization", "description", "category", "region"))


@query("full_search", _t(f"""
    SELECT {_RESULT} FROM tenders WHERE {_HIT.replace('%s', 'build')}
    ORDER BY CASE WHEN lower(tender_no) = 'build' THEN 1 WHEN lower(organization) = 'build' THEN 2
                  WHEN starts_with(lower(tender_no), 'build') THEN 3
                  WHEN starts_with(lower(organization), 'build') THEN 4 ELSE 5 END,
             length(tender_no), tender_no LIMIT 100"""))
def _(spark, sf_dir):
    return _shown(search.full_search(fx.tenders(spark, sf_dir), "Build"))


@query("full_search_ranked", _t(f"""
    SELECT {_RESULT} FROM tenders WHERE {_HIT.replace('%s', '44-10000')}
    ORDER BY CASE WHEN lower(tender_no) = '44-10000' THEN 1 WHEN lower(organization) = '44-10000' THEN 2
                  WHEN starts_with(lower(tender_no), '44-10000') THEN 3
                  WHEN starts_with(lower(organization), '44-10000') THEN 4 ELSE 5 END,
             length(tender_no), tender_no LIMIT 20"""))
def _(spark, sf_dir):
    return _shown(search.full_search(fx.tenders(spark, sf_dir), "44-10000", 20))


@query("full_search_parts", """
    SELECT p_partkey, p_name, p_brand, p_type FROM part
    WHERE contains(lower(p_name), 'ring') OR contains(lower(p_brand), 'ring') OR contains(lower(p_type), 'ring')
    ORDER BY CASE WHEN lower(p_brand) = 'ring' THEN 1 WHEN lower(p_name) = 'ring' THEN 2
                  WHEN starts_with(lower(p_brand), 'ring') THEN 3 WHEN starts_with(lower(p_name), 'ring') THEN 4
                  ELSE 5 END, length(p_brand), p_brand, p_partkey LIMIT 100""")
def _(spark, sf_dir):
    parts = fx.table(spark, sf_dir, "part")
    # Brands repeat, so the key of the order is brand and part number together.
    hits = parts.filter(search.any_column_contains("ring", ["p_name", "p_brand", "p_type"]))
    return hits.orderBy(search.relevance("ring", "p_brand", "p_name"), F.length("p_brand"), "p_brand", "p_partkey") \
        .limit(100).select("p_partkey", "p_name", "p_brand", "p_type")


@query("search_too_short", _t(f"SELECT {_RESULT} FROM tenders WHERE 1 = 0"))
def _(spark, sf_dir):
    return _shown(search.full_search(fx.tenders(spark, sf_dir), " b "))


@query("search_literal_wildcard", _t(f"""
    SELECT {_RESULT} FROM tenders WHERE {_HIT.replace('%s', '#0')}
    ORDER BY length(tender_no), tender_no LIMIT 50"""))
def _(spark, sf_dir):
    return _shown(search.full_search(fx.tenders(spark, sf_dir), "#0", 50))


@query("combined_search", _t(f"""
    SELECT {_RESULT} FROM tenders
    WHERE ({_HIT.replace('%s', 'supply')}) AND lower(category) = 'machinery' AND lower(status) = 'o'
      AND contains(lower(organization), 'customer') AND budget >= 1000 AND budget <= 400000
    ORDER BY id LIMIT 200"""))
def _(spark, sf_dir):
    return _shown(search.combined_search(
        fx.tenders(spark, sf_dir), query="Supply", category="Machinery", region=filters.ALL, status="o",
        organization="CUSTOMER", min_budget=1000.0, max_budget=400_000.0, limit=200))


@query("combined_search_open", _t(f"SELECT {_RESULT} FROM tenders ORDER BY id LIMIT 100"))
def _(spark, sf_dir):
    return _shown(search.combined_search(fx.tenders(spark, sf_dir), query="s", category=filters.ALL, min_budget=-1.0,
                                         max_budget=-5.0, organization=""))


for _column in ("category", "region", "status"):
    @query(f"facet_{_column}", _t(f"""
        SELECT DISTINCT {_column} FROM tenders WHERE {_column} IS NOT NULL AND {_column} <> ''"""))
    def _(spark, sf_dir, column=_column):
        return search.facet_values(fx.tenders(spark, sf_dir), column)


@query("facet_document_language", "SELECT lang, count(*) AS count FROM documents GROUP BY lang")
def _(spark, sf_dir):
    return aggregates.value_counts(fx.table(spark, sf_dir, "documents"), "lang")


@query("document_search", """
    SELECT doc_id, lang, CAST(length(text) AS integer) AS text_length FROM documents
    WHERE contains(lower(text), 'tion') OR contains(lower(lang), 'tion') OR contains(lower(source), 'tion')""")
def _(spark, sf_dir):
    hits = fx.table(spark, sf_dir, "documents").filter(search.any_column_contains("Tion", ["text", "lang", "source"]))
    return hits.select("doc_id", "lang", F.length("text").alias("text_length"))


_TFIDF = """
    texts AS (SELECT id, regexp_replace(lower(t), '[\\s\\x0b\\x1c-\\x1f\\x{{85}}\\p{{Z}}][\\s\\x0b\\x1c-\\x1f\\x{{85}}\\p{{Z}}]+', ' ', 'g') AS t
              FROM ({docs} UNION ALL SELECT -1, '{query}') u),
    chars AS (SELECT id, string_split(t, '') AS c, len(string_split(t, '')) AS n FROM texts),
    grams AS (SELECT id, unnest(list_transform(range(1, n), lambda i: c[i] || c[i + 1])) AS g FROM chars
              UNION ALL SELECT id, unnest(list_transform(range(1, n - 1), lambda i: c[i] || c[i + 1] || c[i + 2])) FROM chars),
    tf AS MATERIALIZED (SELECT id, g, count(*) AS tf FROM grams GROUP BY id, g),
    voc AS (SELECT g, sum(tf) AS total, count(*) AS df FROM tf WHERE id >= 0 GROUP BY g
            ORDER BY total DESC, g LIMIT 5000),
    w AS MATERIALIZED (SELECT id, g, tf * (ln((1 + (SELECT count(*) FROM texts WHERE id >= 0)) / (1 + df)) + 1) AS w
          FROM tf JOIN voc USING (g)),
    norms AS (SELECT id, sqrt(sum(w * w)) AS norm FROM w GROUP BY id),
    scores AS (SELECT d.id, round(sum(d.w * q.w) / (any_value(n.norm) * (SELECT norm FROM norms WHERE id = -1)), 6) AS score,
                      sum(d.w * q.w) / (any_value(n.norm) * (SELECT norm FROM norms WHERE id = -1)) AS exact
               FROM w d JOIN w q ON d.g = q.g AND q.id = -1 JOIN norms n ON n.id = d.id
               WHERE d.id >= 0 GROUP BY d.id)"""
_TENDER_TEXT = "SELECT id, lower(concat_ws(' ', description, category, region, organization)) AS t FROM tenders"


@query("semantic_search", _t("WITH " + _TFIDF.format(docs=_TENDER_TEXT, query="building urgent") + """
    SELECT t.id, t.tender_no, t.description, s.score AS relevance_score FROM scores s JOIN tenders t ON t.id = s.id
    WHERE s.exact > 0.1 ORDER BY s.score DESC, t.id LIMIT 100"""))
def _(spark, sf_dir):
    best = similarity.semantic_search(fx.tenders(spark, sf_dir), "Building urgent", 100)
    return best.select("id", "tender_no", "description", "relevance_score")


@query("similar_documents", "WITH " + _TFIDF.format(docs="SELECT doc_id AS id, text AS t FROM documents",
                                                    query="the question of national attention") + """
    SELECT id AS doc_id, score AS relevance_score FROM scores WHERE exact > 0.1 ORDER BY score DESC, id LIMIT 100""")
def _(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents").select("doc_id", "text")
    return similarity.similar_rows(docs, "The question of national attention", "text", "doc_id", 100)


_GRAMS = """
    texts AS (SELECT lower(concat_ws(' ', description, category, region, organization)) AS t, id FROM tenders),
    chars AS (SELECT id, string_split(t, '') AS c, len(string_split(t, '')) AS n FROM texts),
    grams AS (SELECT id, unnest(list_transform(range(1, n), lambda i: c[i] || c[i + 1])) AS term FROM chars
              UNION ALL SELECT id, unnest(list_transform(range(1, n - 1), lambda i: c[i] || c[i + 1] || c[i + 2])) FROM chars)"""


def _counts(spark, sf_dir):
    texts = fx.tenders(spark, sf_dir).select(
        "id", text.search_text("description", "category", "region", "organization").alias("text"))
    placed, documents = similarity.placed_texts(texts, "id", "text")
    return similarity.term_counts(placed, "id", "text"), documents


@query("term_totals", _t(f"""WITH {_GRAMS}
    SELECT term, CAST(sum(n) AS bigint) AS total, count(*) AS docs
    FROM (SELECT id, term, count(*) AS n FROM grams GROUP BY id, term) d GROUP BY term"""))
def _(spark, sf_dir):
    return similarity.term_totals(_counts(spark, sf_dir)[0])


@query("vocabulary_weights", _t(f"""WITH {_GRAMS}
    SELECT term, round(ln((1 + (SELECT count(*) FROM texts)) / (1 + docs)) + 1, 6) AS idf
    FROM (SELECT term, sum(n) AS total, count(*) AS docs
          FROM (SELECT id, term, count(*) AS n FROM grams GROUP BY id, term) d
          GROUP BY term ORDER BY total DESC, term LIMIT 5000) v"""))
def _(spark, sf_dir):
    counts, documents = _counts(spark, sf_dir)
    return rounded(similarity.vocabulary(similarity.term_totals(counts), documents, similarity.MAX_TERMS), 6)


@query("newest_corpus", _t("""
    SELECT id, strftime(published_at, '%Y-%m-%d') AS published_at FROM tenders
    ORDER BY tenders.published_at DESC, id LIMIT 10000"""))
def _(spark, sf_dir):
    return as_text(similarity.newest_rows(fx.tenders(spark, sf_dir), "published_at", "id", 10_000)
                   .select("id", "published_at"), published_at=DAY)


@query("search_page_statistics", _t("""
    SELECT count(*) AS count, round(coalesce(avg(budget), 0), 2) AS avg_budget,
           round(coalesce(sum(budget), 0), 2) AS total_budget, round(coalesce(min(budget), 0), 2) AS min_budget,
           round(coalesce(max(budget), 0), 2) AS max_budget, count(DISTINCT category) AS categories,
           count(DISTINCT region) AS regions
    FROM (SELECT * FROM tenders WHERE contains(lower(description), 'urgent') AND lower(status) = 'f' AND budget <= 300000) hits"""))
def _(spark, sf_dir):
    page = search_page.page(fx.tenders(spark, sf_dir), query="urgent", status="F", max_budget=300_000.0, limit=500)
    return rounded(page["statistics"])


@query("search_page_categories", _t("""
    SELECT category, count(*) AS count
    FROM (SELECT * FROM tenders WHERE lower(status) = 'f') hits GROUP BY category"""))
def _(spark, sf_dir):
    return search_page.page(fx.tenders(spark, sf_dir), status="F", limit=500)["by_category"]
