"""Search front end: facets, results and their statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tenderlake.operators import aggregates, search


def page(tenders: DataFrame, limit: int = 100, **filters) -> dict[str, DataFrame]:
    """Frames of one search page; the keywords are those of ``all_hits``.

    Only the rows shown are limited; statistics cover every hit.
    """
    hits = search.all_hits(tenders, **filters)
    return {
        "categories": search.facet_values(tenders, "category"),
        "regions": search.facet_values(tenders, "region"),
        "statuses": search.facet_values(tenders, "status"),
        "budget_range": search.budget_range(tenders),
        "results": search.combined_search(tenders, limit=limit, **filters),
        "statistics": search.results_stats(hits),
        "by_category": aggregates.value_counts(hits, "category"),
    }
