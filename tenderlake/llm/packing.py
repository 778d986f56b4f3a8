"""Batches of padded texts from optimal length buckets.

The histogram of all lengths is small, so the bucket borders that minimise
padding are found exactly by dynamic programming on the driver. Inside a
bucket texts are numbered without gathering them and cut into batches that
hold as many padded texts as the token budget allows.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenderlake.llm import encoding
from tenderlake.llm.common import binary_text, stored, text_batches

#: Rows numbered together by one task.
SLICE_ROWS = 20_000
#: Bytes of text encoded together: many pieces come again.
ENCODED = 16 << 20


def token_lengths(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  tokenizer: str = "byte_bpe_50k.json") -> DataFrame:
    """(id, n_tokens) of every row: ids of the whole text under an installed tokenizer, none for null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoding.encoder(encoding.tokenizer_path(tokenizer))
        for batch in text_batches(batches, ENCODED):
            found = codec.lengths(batch.column(1).cast(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], [id_col, "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, binary_text(text_col).alias("text")).mapInArrow(run, f"`{id_col}` {kind}, n_tokens long")


def borders(cells: list[tuple[int, int, int]], buckets: int) -> list[int]:
    """Upper borders of at most ``buckets`` length buckets with the least padding.

    ``cells``: (longest, texts, sum of lengths) in ascending order. The cost of
    padding cells i+1..j to the longest of j is ``longest_j * (N_j - N_i) -
    (S_j - S_i)`` with running counts N and sums S. For a fixed j it is a
    line in longest_j for each i, with slopes -N_i that fall as i grows, so
    the best i is kept on a lower envelope of lines.
    """
    counts, sums = [0], [0]
    for _, n, total in cells:
        counts.append(counts[-1] + n)
        sums.append(sums[-1] + total)
    best = [0] + [float("inf")] * len(cells)
    back: list[list[int]] = []
    for _ in range(min(buckets, len(cells))):
        hull: deque[tuple[int, int, int]] = deque()  # slope, intercept, i
        now, came = [float("inf")] * len(best), [0] * len(best)
        for j in range(1, len(best)):
            if best[j - 1] != float("inf"):
                line = (-counts[j - 1], best[j - 1] + sums[j - 1], j - 1)
                while len(hull) > 1 and (line[1] - hull[-2][1]) * (hull[-2][0] - hull[-1][0]) <= \
                        (hull[-1][1] - hull[-2][1]) * (hull[-2][0] - line[0]):
                    hull.pop()
                hull.append(line)
            longest = cells[j - 1][0]
            while len(hull) > 1 and hull[1][0] * longest + hull[1][1] <= hull[0][0] * longest + hull[0][1]:
                hull.popleft()
            if hull:
                now[j] = hull[0][0] * longest + hull[0][1] + longest * counts[j] - sums[j]
                came[j] = hull[0][2]
        back.append(came)
        best = now
    # With as many cells as layers or more, exactly that many buckets are never worse than fewer.
    out, at = [], len(cells)
    for came in reversed(back):
        out.append(cells[at - 1][0])
        at = came[at]
    return out[::-1]


def pack(docs: DataFrame, buckets: int = 16, budget: int = 16_384, id_col: str = "doc_id",
         length: Column | None = None) -> DataFrame:
    """(id, n_tokens, bucket, bucket_length, batch, slot) of every row.

    Batches of a bucket hold ``budget // bucket_length`` rows, each padded to
    bucket_length, at least one: a text longer than the budget is a batch by
    itself and is not cut. All batches but the last of a bucket are full.
    Without ``length``, a column of lengths, the tokens of the whole texts are
    counted. Rows of equal id are numbered in order of length; null ids come
    first. The driver holds one cell for each length that occurs.
    """
    if length is None:
        docs, length = token_lengths(docs, id_col), F.col("n_tokens")
    sized = stored(docs.select(F.col(id_col).alias("id"), length.cast("long").alias("n_tokens")), "sized")
    cells = sorted((r["n_tokens"], r["n"], r["n_tokens"] * r["n"]) for r in
                   sized.groupBy("n_tokens").agg(F.count("*").alias("n")).collect())
    ends = borders(cells, buckets)
    bucket, size, room = F.lit(0), F.lit(0), F.lit(1)
    for k, end in reversed(list(enumerate(ends))):
        inside = F.col("n_tokens") <= end
        bucket, size = F.when(inside, k).otherwise(bucket), F.when(inside, end).otherwise(size)
        room = F.when(inside, max(1, budget // max(end, 1))).otherwise(room)
    slices = -(-sum(n for _, n, _ in cells) // SLICE_ROWS) or 1
    placed = sized.select("id", "n_tokens", bucket.alias("bucket"), size.cast("long").alias("bucket_length"),
                          room.cast("long").alias("room"), F.pmod(F.xxhash64("id"), F.lit(slices)).alias("slice"))
    before = Window.partitionBy("bucket").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("bucket", "slice").count().select(
        "bucket", "slice", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    number = F.row_number().over(Window.partitionBy("bucket", "slice").orderBy("id", "n_tokens"))
    # Each (bucket, slice) has one start, and a hashed slice has a bounded number of rows.
    numbered = placed.withColumn("number", number).join(starts, ["bucket", "slice"])
    at = F.col("first") + F.col("number") - 1
    return numbered.select("id", "n_tokens", "bucket", "bucket_length", F.floor(at / F.col("room")).alias("batch"),
                           (at % F.col("room")).alias("slot"))


def bucket_of(length: int, ends: list[int]) -> int:
    return bisect_left(ends, length)
