import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tenderlake.operators import filters, search, similarity
from tests.test_text import brute_grams

TENDERS = [
    (1, "44-1", "ООО Ромашка", "Ремонт ШКОЛЫ", "Строительство", "Москва", 100.0, "Объявлена"),
    (2, "44-22", "Школа", "Мебель", "Образование", "СПб", 500.0, "Закрыта"),
    (3, "школа-3", "ГБУ 100%", "Парты", "Образование", "Казань", None, "Объявлена"),
    (4, "44-4", "школа искусств", "Рояль", "Образование", "москва", 0.0, "Отменена"),
    (5, "44-5", None, None, "IT", "Москва", 500.0, ""),
]
COLUMNS = "id long, tender_no string, organization string, description string, category string, region string, budget double, status string"


@pytest.fixture(scope="module")
def tenders(spark):
    return spark.createDataFrame(TENDERS, COLUMNS).withColumn("published_at", F.lit("2024-01-01").cast("timestamp"))


def test_full_search_orders_by_relevance(tenders):
    got = [r.tender_no for r in search.full_search(tenders, "Школ").collect()]
    assert got == ["школа-3", "44-4", "44-22", "44-1"]
    assert [r.tender_no for r in search.full_search(tenders, "ШКОЛА").collect()] == ["44-22", "школа-3", "44-4"]
    assert search.full_search(tenders, "школ", 2).count() == 2


@pytest.mark.parametrize("query", ["", " ", "a", " b ", None])
def test_short_query_is_empty(tenders, query):
    assert search.full_search(tenders, query).collect() == []
    assert search.full_search(tenders, query).columns == search.RESULT_COLUMNS


def test_wildcards_are_literal(tenders):
    assert [r.tender_no for r in search.full_search(tenders, "0%").collect()] == ["школа-3"]
    assert search.full_search(tenders, "4_").collect() == []


def test_combined_search(tenders):
    def ids(**kw):
        return [r.tender_no for r in search.combined_search(tenders, **kw).collect()]

    assert ids(region="МОСКВА") == ["44-1", "44-4", "44-5"]
    assert ids(region="Москва", min_budget=0) == ["44-1", "44-4", "44-5"]
    assert ids(min_budget=1.0) == ["44-1", "44-22", "44-5"]
    assert ids(max_budget=0.0) == ["44-4"]
    assert ids(min_budget=-1, max_budget=-1, category=filters.ALL, query="x") == ["44-1", "44-22", "школа-3", "44-4", "44-5"]
    assert ids(organization="шк", category="образование", status="закрыта") == ["44-22"]


def test_single_filters(tenders):
    assert [r.id for r in filters.by_region(tenders, "москва").collect()] == [5, 1, 4]
    assert [r.id for r in filters.by_budget(tenders, 100, 500).collect()] == [2, 5, 1]
    assert [r.id for r in filters.by_organization(tenders, "ШКОЛА").collect()] == [2, 4]
    assert [r.id for r in filters.by_category(tenders, "ОБРАЗОВАНИЕ", 1).collect()] == [2]


def test_facets_and_statistics(tenders, rows):
    assert [r.status for r in search.facet_values(tenders, "status").collect()] == ["Закрыта", "Объявлена", "Отменена"]
    assert tuple(search.budget_range(tenders).first()) == (100.0, 500.0)
    assert tuple(search.budget_range(tenders.limit(0)).first()) == (0.0, 1_000_000.0)
    total = search.total_stats(tenders).first()
    assert (total.total_count, total.organizations_count, total.total_budget) == (4, 3, 1100.0)
    assert search.total_stats(tenders.limit(0)).first().avg_budget == 0.0
    assert search.total_stats(tenders, approximate=True).first().categories_count == 3
    stats = search.results_stats(tenders).first()
    assert (stats["count"], stats.avg_budget, stats.categories) == (5, 275.0, 3)
    assert search.results_stats(tenders.limit(0)).first()["count"] == 0


def brute_tfidf(docs, query, max_terms):
    """Dictionary-based ranking to compare with."""
    tf = {k: Counter(brute_grams(t)) for k, t in docs.items() if t is not None}
    total, df = Counter(), Counter()
    for counts in tf.values():
        total.update(counts)
        df.update(counts.keys())
    terms = sorted(total, key=lambda g: (-total[g], g.encode()))[:max_terms]
    idf = {g: math.log((1 + len(docs)) / (1 + df[g])) + 1 for g in terms}
    def weigh(counts):
        return {g: n * idf[g] for g, n in counts.items() if g in idf}
    def norm(w):
        return math.sqrt(sum(x * x for x in w.values()))
    q = weigh(Counter(brute_grams(query)))
    scores = {}
    for key, counts in tf.items():
        w = weigh(counts)
        if norm(w) and norm(q):
            score = sum(x * q.get(g, 0) for g, x in w.items()) / norm(w) / norm(q)
            if score > 0.1:
                scores[key] = round(score, 6)
    return scores


@pytest.mark.parametrize("max_terms", [20, 5000])
def test_similarity_equals_brute_force(spark, max_terms):
    words = ["ремонт дорог", "дорога  в школу", "школьная мебель", "сервер и софт", "a", "", "дом у дороги 😀"]
    docs = {i: " ".join([words[i % 7], words[(i * 3) % 7]]) for i in range(60)}
    docs[60] = None
    df = spark.createDataFrame(list(docs.items()), "id long, t string").repartition(5)
    got = {r.id: r.relevance_score for r in
           similarity.similar_rows(df, "Дорога", "t", limit=1000, max_terms=max_terms).collect()}
    assert got == pytest.approx(brute_tfidf(docs, "Дорога", max_terms), abs=2e-6)


def test_similarity_limit_ties_and_no_match(spark):
    df = spark.createDataFrame([(i, "дорога") for i in range(10)], "id long, t string")
    assert [r.id for r in similarity.similar_rows(df, "дорога", "t", limit=3).collect()] == [0, 1, 2]
    assert similarity.similar_rows(df, "xyz", "t").collect() == []
    assert similarity.similar_rows(df, "д", "t").collect() == []


def test_semantic_search_corpus_limit(tenders):
    got = similarity.semantic_search(tenders, "школа", corpus_limit=2).collect()
    assert {r.id for r in got} <= {1, 2} and got


def test_term_counts_keep_no_table_of_terms(spark, monkeypatch):
    texts = {1: ["дорога  в 😀😀 школу", "aaa"], 2: ["AAA aaa", None], 3: ["x"], 4: [None], 5: [" \tдорога"] * 2}
    df = spark.createDataFrame([(k, t) for k, several in texts.items() for t in several], "id long, t string").repartition(1)
    monkeypatch.setattr(similarity, "CHARS_AT_ONCE", 8)
    counts = similarity.term_counts(similarity.placed_texts(df, "id", "t")[0], "id", "t")
    want = {k: sum((Counter(brute_grams(t)) for t in several if t is not None), Counter()) for k, several in texts.items()}
    got = [(r.id, r.term, r.tf) for r in counts.collect()]
    assert sorted(got) == sorted((k, g, n) for k, c in want.items() for g, n in c.items())
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "term" not in "".join(line for line in plan.splitlines() if "Aggregate" in line)
