"""TF-IDF similarity search over character n-grams.

An index expands the texts once. They are shuffled by document and counted in
Arrow batches, so term counts stay inside the partitioning; only distinct terms per task travel to form
totals and document frequencies. The cut vocabulary (at most ``max_terms``
rows) is broadcast to the counts, whose weights are stored in order of term
together with the norm of each document. A search reads the postings of its
own terms and the norms.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tenderlake.functions import text
from tenderlake.operators.search import too_short
from tenderlake.session import scratch_path, stored

# Parameters of the ranking.
MAX_TERMS = 5000
THRESHOLD = 0.1
GRAMS = (2, 3)
# Text per task: two n-grams per character, about half of them distinct.
CHARS_PER_TASK = 8_000_000
# Text whose grams are counted together.
CHARS_AT_ONCE = 500_000


def newest_rows(df: DataFrame, time: str, key: str, limit: int | None) -> DataFrame:
    """The newest rows as the corpus; without a limit the whole table."""
    return df if limit is None else df.orderBy(F.desc(time), F.asc(key)).limit(limit)


def placed_texts(corpus: DataFrame, key: str, column: str) -> tuple[DataFrame, int]:
    """The texts partitioned by document and the number of documents.

    The number of partitions follows the amount of text, so that the term
    counts of one task fit in memory.
    """
    size = corpus.agg(F.count(F.lit(1)).alias("documents"), F.sum(F.length(column)).alias("chars")).first()
    usual = int(corpus.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    partitions = max(usual, -(-(size["chars"] or 0) // CHARS_PER_TASK))
    return corpus.select(key, column).repartition(partitions, key), size["documents"]


def term_counts(placed: DataFrame, key: str, column: str, grams: tuple[int, int] = GRAMS) -> DataFrame:
    """(key, term, tf) of texts that are partitioned by the key.

    The grams of some documents at a time are numbered and counted as arrays,
    so no task keeps a table of the terms of all its documents.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.list_value_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False)
            texts = batch.column(1).flatten().to_pylist()
            owner = np.repeat(np.arange(batch.num_rows), sizes)
            heights = np.cumsum([0, *map(len, texts)])
            begin = 0
            while begin < len(texts):
                # All texts of a document go together.
                end = max(begin + 1, int(np.searchsorted(heights, heights[begin] + CHARS_AT_ONCE, side="right")) - 1)
                end = int(np.searchsorted(owner, owner[end - 1], side="right"))
                for rows, terms, tf in _counted(texts[begin:end], owner[begin:end], grams):
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), terms, tf], [key, "term", "tf"])
                begin = end

    clean = F.transform("__texts", text.single_spaced)
    documents = placed.groupBy(key).agg(F.collect_list(column).alias("__texts")).select(key, clean.alias("__texts"))
    kinds = StructType([documents.schema[key], StructField("term", StringType()), StructField("tf", LongType())])
    return documents.mapInArrow(count, kinds)


def _counted(texts: list[str], owner: np.ndarray, grams: tuple[int, int]) -> Iterator[tuple[pa.Array, pa.Array, pa.Array]]:
    """(owner, term, occurrences) for each length of grams; a gram is numbered by its head, one shorter, and its last character."""
    joined = "".join(texts)
    chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    inside = np.repeat(np.arange(len(texts)), np.fromiter(map(len, texts), np.int64, len(texts)))
    head, at = chars, np.arange(len(chars))
    for n in range(2, grams[1] + 1):
        at = at[at + n - 1 < len(chars)]
        whole = inside[at] == inside[at + n - 1]
        head, at = head[:len(at)][whole], at[whole]
        number, first, head = np.unique((head << 21) + chars[at + n - 1], return_index=True, return_inverse=True)
        if n >= grams[0] and len(at):
            found, tf = np.unique(owner[inside[at]] * len(number) + head, return_counts=True)
            rows, term = np.divmod(found, len(number))
            terms = pa.array([joined[p:p + n] for p in at[first].tolist()], pa.string())
            yield pa.array(rows), terms.take(pa.array(term)), pa.array(tf.astype(np.int64))


def term_totals(counts: DataFrame) -> DataFrame:
    """(term, total, docs): occurrences and containing documents."""
    return counts.groupBy("term").agg(F.sum("tf").alias("total"), F.count(F.lit(1)).alias("docs"))


def vocabulary(totals: DataFrame, documents: int, max_terms: int = MAX_TERMS) -> DataFrame:
    """(term, idf) of the most frequent terms, smoothed ``ln((1+n)/(1+df)) + 1``."""
    top = totals.orderBy(F.desc("total"), F.asc("term")).limit(max_terms)
    return top.select("term", (F.log(F.lit(1.0 + documents) / (F.lit(1.0) + F.col("docs"))) + F.lit(1.0)).alias("idf"))


def weighted_vocabulary(terms: DataFrame, query: str, grams: tuple[int, int] = GRAMS) -> DataFrame:
    """(term, idf, query_weight): the unit-length query vector over the vocabulary.

    The query is one literal; its term counts are array look-ups, no join.
    """
    occurrences = F.size(F.filter(text.char_grams(F.lit(query), *grams), lambda g: g == F.col("term")))
    # The window spans the cut vocabulary only.
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(F.lit(0))))
    return (terms.withColumn("w", occurrences * F.col("idf"))
            .select("term", "idf", F.try_divide("w", norm).alias("query_weight")))


@dataclass(frozen=True)
class TermIndex:
    """Stored term counts of a corpus: (key, term, tf) in order of term, and what every search needs of them."""

    key: str
    postings: DataFrame
    terms: DataFrame
    norms: DataFrame
    grams: tuple[int, int]


def build_index(corpus: DataFrame, column: str, key: str = "id", max_terms: int = MAX_TERMS,
                grams: tuple[int, int] = GRAMS) -> TermIndex:
    """Expand every text once and store its counts.

    Only terms of the vocabulary are kept: (term, idf), the postings with
    their weights and the norm of each document.
    """
    spark = corpus.sparkSession
    path = scratch_path(spark, "term-index")

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{path}/{name}")
        return spark.read.schema(df.schema).parquet(f"{path}/{name}")

    placed, documents = placed_texts(corpus, key, column)
    counts = kept(term_counts(placed, key, column, grams), "counts")
    terms = kept(vocabulary(term_totals(counts), documents, max_terms), "terms")
    # At most ``max_terms`` rows, so the broadcast does not grow with the corpus. Postings keep the tasks of the
    # counts and are ordered inside them: a search skips the row groups without its terms.
    weighted = counts.join(F.broadcast(terms), "term").select(key, "term", (F.col("tf") * F.col("idf")).alias("weight"))
    postings = kept(weighted.sortWithinPartitions("term"), "postings")
    norms = kept(postings.groupBy(key).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm")), "norms")
    return TermIndex(key, postings, terms, norms, grams)


def search_index(index: TermIndex, query: str, limit: int = 100, threshold: float = THRESHOLD) -> DataFrame:
    """(key, relevance_score) of the documents most similar to the query; reads the postings of its terms only.

    Scores are rounded to six decimals before ranking so that equal documents
    tie; ties go to the smaller key.
    """
    if too_short(query):
        return index.norms.select(index.key, F.lit(0.0).alias("relevance_score")).limit(0)
    weights = weighted_vocabulary(index.terms, query, index.grams).where("query_weight > 0")
    wanted = sorted(r["term"] for r in weights.select("term").collect())  # the query's own terms
    dots = index.postings.where(F.col("term").isin(wanted)).join(F.broadcast(weights), "term").groupBy(
        index.key).agg(F.sum(F.col("weight") * F.col("query_weight")).alias("dot"))
    scored = dots.join(index.norms, index.key).select(index.key, F.try_divide("dot", "norm").alias("score"))
    return _best(scored, index.key, limit, threshold)


def _best(scored: DataFrame, key: str, limit: int, threshold: float) -> DataFrame:
    return (scored.where(F.col("score") > F.lit(threshold)).select(key, F.round("score", 6).alias("relevance_score"))
            .orderBy(F.desc("relevance_score"), F.asc(key)).limit(limit))


def similar_rows(df: DataFrame, query: str, column: str, key: str = "id", limit: int = 100,
                 threshold: float = THRESHOLD, max_terms: int = MAX_TERMS,
                 grams: tuple[int, int] = GRAMS) -> DataFrame:
    """One search over a corpus without an index; ``build_index`` serves several.

    The counts are stored once, for the vocabulary and for the scores; weights
    and norms are summed by document as they are read, and never stored.
    """
    if too_short(query):
        return df.select(key, F.lit(0.0).alias("relevance_score")).limit(0)
    placed, documents = placed_texts(df, key, column)
    counts = stored(term_counts(placed, key, column, grams), "term-counts")
    terms = stored(vocabulary(term_totals(counts), documents, max_terms), "terms")
    # At most ``max_terms`` rows, so the broadcast does not grow with the corpus.
    weights = F.broadcast(weighted_vocabulary(terms, query, grams))
    weight, asked = F.col("tf") * F.col("idf"), F.coalesce("query_weight", F.lit(0.0))
    sums = counts.join(weights, "term").groupBy(key).agg(F.sum(weight * asked).alias("dot"), F.sum(weight * weight).alias("square"))
    return _best(sums.select(key, F.try_divide("dot", F.sqrt("square")).alias("score")), key, limit, threshold)


def semantic_search(df: DataFrame, query: str, limit: int = 100, corpus_limit: int | None = None) -> DataFrame:
    """Similar tenders with their columns, best first."""
    corpus = newest_rows(df, "published_at", "id", corpus_limit)
    texts = corpus.select("id", text.search_text("description", "category", "region", "organization").alias("text"))
    best = similar_rows(texts, query, "text", limit=limit)
    # At most ``limit`` rows: the user's own bound on the result.
    return df.join(F.broadcast(best), "id").orderBy(F.desc("relevance_score"), F.asc("id"))
