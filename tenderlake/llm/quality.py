"""Importance resampling towards a target: hashed n-gram models and Gumbel top-k.

Words and word pairs are hashed to buckets. One model holds how often each
bucket occurs in target texts, the other how often in all texts; the log of
their ratio, summed over a text, is its importance weight. Adding Gumbel noise
to the log weights and keeping the k largest sums draws k texts without
replacement in proportion to their weights.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake.llm import hashing
from tenderlake.llm.common import binary_text, stored, text_batches, text_bytes

BITS = 14
BUCKETS = 1 << BITS
#: Bins of one pass of the search for the k-th key, and rows from which it is read off.
BINS, READ_OFF = 4096, 5_000


def bucket_ids(text: bytes) -> np.ndarray:
    """Buckets of all words and word pairs of a text."""
    octets, spaces = hashing.spaced_words(text)
    if len(octets) < 3:
        return np.empty(0, np.int64)
    words = hashing.mixed(hashing.substrings(hashing.prefix(octets), spaces[:-1] + 1, spaces[1:]))
    pairs = hashing.mixed(words[:-1] * np.uint64(3) + words[1:])
    return (np.concatenate([words, pairs]) >> np.uint64(64 - BITS)).astype(np.int64)


def target_sample(labels: DataFrame, most: int = 20_000) -> DataFrame:
    """doc_id of target texts: labelled quality 1, at most ``most`` of them, those of the smallest hashed ids."""
    good = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def log_ratios(docs: DataFrame, target: DataFrame, smoothing: float = 1.0) -> np.ndarray:
    """Log of target share over raw share of each bucket.

    Raw counts come from every text. Each task adds up its own texts first;
    what travels is one row for each task and bucket.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, wanted = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in text_batches(batches):
            for text, is_target in zip(text_bytes(batch.column(0)), batch.column(1).to_pylist()):
                found = np.bincount(bucket_ids(text), minlength=BUCKETS)
                raw += found
                if is_target:
                    wanted += found
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS, dtype=np.int32)), pa.array(raw),
                                          pa.array(wanted)], ["bucket", "raw", "wanted"])

    # The sample of the target is bounded, so it can be sent to every task.
    marked = docs.select("doc_id", binary_text().alias("text")).join(
        F.broadcast(target.withColumn("is_target", F.lit(True))), "doc_id", "left").select("text", "is_target")
    counts = marked.mapInArrow(count, "bucket int, raw long, wanted long").groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("wanted").alias("wanted")).toArrow()
    raw, wanted = np.zeros(BUCKETS), np.zeros(BUCKETS)
    place = counts.column("bucket").to_numpy()
    raw[place], wanted[place] = counts.column("raw").to_numpy(), counts.column("wanted").to_numpy()
    share = lambda x: (x + smoothing) / (x.sum() + smoothing * BUCKETS)
    return np.log(share(wanted)) - np.log(share(raw))


def weigh(docs: DataFrame, ratios: np.ndarray, seed: int = 0) -> DataFrame:
    """(doc_id, n_grams, log_weight, key) of every row; key is the log weight plus Gumbel noise drawn from the id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches):
            found = [bucket_ids(t) for t in text_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(f) for f in found], pa.int64()),
                 pa.array([float(ratios[f].sum()) for f in found], pa.float64())], ["doc_id", "n_grams", "log_weight"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    weighed = docs.select("doc_id", binary_text().alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_grams long, log_weight double")
    # 52 hashed bits, moved off 0 and 1: the same draw however often a task is repeated.
    even = (F.xxhash64("doc_id", F.lit(seed)).bitwiseAND((1 << 52) - 1) + 0.5) / float(1 << 52)
    return weighed.withColumn("key", F.col("log_weight") - F.log(-F.log(even)))


def top_k(rows: DataFrame, k: int, key: str = "key", tie: str = "doc_id") -> DataFrame:
    """The k rows of largest key, ties by the smaller ``tie``; rows equal in both are kept or left together.

    k may be most of the table, so nothing is sorted: histograms narrow down
    the bin that holds the k-th key, and that bin alone is read off.
    ``rows`` should be stored, as it is read a few times.
    """
    low, high, n = rows.agg(F.min(key), F.max(key), F.count(key)).first()
    if k <= 0 or not n:
        return rows.limit(0)
    if k >= n:
        return rows.where(F.col(key).isNotNull())
    above, inside = 0, n
    while inside > READ_OFF and low < high:
        step = (high - low) / BINS
        place = F.least(F.floor((F.col(key) - low) / step), F.lit(BINS - 1)) if step > 0 else F.lit(0)
        bins = {r["bin"]: r for r in rows.where(F.col(key).between(low, high)).groupBy(place.alias("bin")).agg(
            F.count("*").alias("n"), F.min(key).alias("low"), F.max(key).alias("high")).collect()}
        for b in sorted(bins, reverse=True):
            if above + bins[b]["n"] >= k:
                break
            above += bins[b]["n"]
        if bins[b]["n"] == inside:
            break
        low, high, inside = bins[b]["low"], bins[b]["high"], bins[b]["n"]
    # The bin holds few rows, or very many of one key: the edge is then found among their ties.
    edge = rows.where(F.col(key).between(low, high))
    if inside <= READ_OFF:
        last = edge.orderBy(F.desc(key), F.asc_nulls_first(tie)).limit(k - above).orderBy(
            F.asc(key), F.desc_nulls_last(tie)).first()
        edge_key, edge_tie = last[key], last[tie]
    else:
        edge_key, edge_tie = low, _kth_tie(edge, k - above, tie)
    at_edge = F.col(key) == edge_key
    within = F.col(tie).isNull() if edge_tie is None else F.col(tie).isNull() | (F.col(tie) <= edge_tie)
    return rows.where((F.col(key) > edge_key) | (at_edge & within))


def _kth_tie(rows: DataFrame, k: int, tie: str):
    """The k-th smallest ``tie`` of a table of one key, by halving the range of the numbers."""
    nulls = rows.where(F.col(tie).isNull()).count()
    if k <= nulls:
        return None
    low, high = rows.agg(F.min(tie), F.max(tie)).first()
    while low < high:
        middle = (low + high) // 2
        if nulls + rows.where(F.col(tie) <= middle).count() >= k:
            high = middle
        else:
            low = middle + 1
    return low


def resample(docs: DataFrame, labels: DataFrame, share: float | None = None, most_targets: int = 20_000,
             seed: int = 0) -> DataFrame:
    """(doc_id, n_grams, log_weight, key) of the rows drawn.

    ``share`` of the rows is drawn; by default as many as there are target
    rows among the labelled ones. Null and empty texts have weight 1 and take
    part; a table without labels has no target and all weights are equal.
    """
    target = stored(target_sample(labels, most_targets), "target")
    weighed = stored(weigh(docs, log_ratios(docs, target), seed), "weighed")
    if share is None:
        share = labels.agg(F.avg(F.when(F.col("quality") == 1, 1.0).when(F.col("quality") == 0, 0.0))).first()[0]
        share = 1.0 if share is None else share
    return top_k(weighed, round(share * weighed.count()))
