"""Interaction of filters, counted for every order in which they could be applied.

A document is known by the set of filters that it fails (its mask), and only
masks are counted over the documents. A filter removes a mask at some step of
an order if the order's letters before that step are all outside the mask.
Orders numbered in lexicographic sequence (by Lehmer rank) that begin alike
are consecutive, so each mask is removed at a step on a few intervals of
ranks. The counts of a mask are added at the first rank of an interval and
taken off behind its last; running sums over the ranks are the totals of every
order.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenderlake.llm.common import stored

#: Text rules of :func:`failures`.
SPACE = r"[\x20\x09-\x0D]+"
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 200, 50, 2
MARKS = r"[#$%&*|]"

MEASURES = ("n", "good", "toxic")


def failures(text: str = "text") -> dict[str, Column]:
    """Failure conditions of the text rules A to D; a null text counts as empty.

    A: few words. B: few different words. C: many capitals. D: markup signs.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(body, SPACE), lambda w: w != "")
    count, distinct = F.size(words), F.size(F.array_distinct(words))
    return {"A": count < LEAST_WORDS, "B": 100 * distinct < DISTINCT_PERCENT * count,
            "C": 100 * F.regexp_count(body, F.lit("[A-Z]")) > CAPITAL_PERCENT * F.char_length(body),
            "D": body.rlike(MARKS)}


def repeated(rows: DataFrame, key: str, id_col: str) -> DataFrame:
    """``rows`` and a column ``repeat``: another row with this key has a smaller id.

    The smallest id of each key is a partial minimum; rows meet it under key
    and id, of which no group of copies shares more than repeated rows. Null
    ids are neither smaller nor larger than others.
    """
    first = rows.groupBy(key).agg(F.min(id_col).alias(id_col)).withColumn("first", F.lit(True))
    return rows.join(first, [key, id_col], "left").withColumn(
        "repeat", F.col("first").isNull() & F.col(id_col).isNotNull()).drop("first")


def orders(letters: str) -> list[str]:
    """All orders of the filters; the place in the list is the Lehmer rank."""
    return ["".join(p) for p in permutations(sorted(letters))]


def intervals(letters: str) -> Iterator[tuple[int, int, int, int]]:
    """(mask, step, first rank, end rank) of the ranks at which a mask is removed at a step (from 1)."""
    letters = sorted(letters)
    for mask in range(1, 1 << len(letters)):
        inside = {x for k, x in enumerate(letters) if mask >> k & 1}
        found: list[list[int]] = []

        def walk(left: list[str], step: int, first: int) -> None:
            size = factorial(len(left) - 1)
            for k, letter in enumerate(left):
                begin = first + k * size
                if letter not in inside:
                    walk(left[:k] + left[k + 1:], step + 1, begin)
                else:
                    found.append([step, begin, begin + size])

        walk(letters, 1, 0)
        found.sort()
        for at in range(len(found) - 1, 0, -1):
            if found[at][0] == found[at - 1][0] and found[at][1] == found[at - 1][2]:
                found[at - 1][2] = found.pop(at)[2]
        yield from ((mask, *x) for x in found)


def audit(rows: DataFrame, failing: dict[str, Column], part: Column, good: Column, toxic: Column) -> DataFrame:
    """(part, filter_order, step, filter, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley).

    One row for each part, each order of the filters (single letters) and each
    step. kept: documents left after the step. removed: those that the step
    takes; good_lost and toxic_lost of them. redundant: those failing its
    filter that an earlier step took. unique_fails: those failing no other
    filter. shapley: what the filter removes, summed over all orders. A null
    part is the empty string; a null condition or label counts as false. A
    table without rows has no part and no result.
    """
    spark = rows.sparkSession
    letters = sorted(failing)
    ranked, steps = orders("".join(letters)), len(letters)
    mask = sum((F.when(failing[x].cast("boolean"), 1 << k).otherwise(0) for k, x in enumerate(letters)), F.lit(0))
    one = lambda c: F.sum(F.when(c.cast("boolean"), 1).otherwise(0))
    counts = stored(rows.groupBy(F.coalesce(part.cast("string"), F.lit("")).alias("part"), mask.alias("mask")).agg(
        F.count(F.lit(1)).alias("n"), one(good).alias("good"), one(toxic).alias("toxic")), "mask-counts")

    # 1,680 rows at five filters, made from their number alone.
    ends = [(m, s, at, sign) for m, s, first, end in intervals("".join(letters)) for at, sign in ((first, 1), (end, -1))
            if at < len(ranked)]
    table = spark.createDataFrame(ends, "mask int, step int, rank int, sign int")
    added = counts.join(table, "mask").select(
        "part", "step", "rank", *((F.col("sign") * F.col(m)).alias(m) for m in MEASURES))
    # Every part has a zero at every rank and step.
    parts = counts.select("part").distinct()
    zeros = parts.select("part", F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("step")).select(
        "part", "step", F.explode(F.sequence(F.lit(0), F.lit(len(ranked) - 1))).alias("rank"),
        *(F.lit(0).cast("long").alias(m) for m in MEASURES))
    points = added.unionByName(zeros).groupBy("part", "step", "rank").agg(*(F.sum(m).alias(m) for m in MEASURES))

    along = Window.partitionBy("part", "step").orderBy("rank")
    name = F.element_at(F.array(*map(F.lit, ranked)), F.col("rank") + 1)
    removed = points.select("part", "step", "rank", *(F.sum(m).over(along).alias(m) for m in MEASURES)) \
        .withColumn("filter_order", name).withColumn("filter", F.col("filter_order").substr(F.col("step"), F.lit(1)))

    bit = lambda k: F.col("mask").bitwiseAND(1 << k) != 0
    per_filter = F.explode(F.array(*(F.struct(
        F.lit(x).alias("filter"), F.when(bit(k), F.col("n")).otherwise(0).alias("fails"),
        F.when(F.col("mask") == 1 << k, F.col("n")).otherwise(0).alias("alone"), F.col("n").alias("all"))
        for k, x in enumerate(letters)))).alias("f")
    totals = counts.select("part", per_filter).groupBy("part", "f.filter").agg(
        F.sum("f.fails").alias("fails"), F.sum("f.alone").alias("unique_fails"), F.sum("f.all").alias("documents"))

    so_far = Window.partitionBy("part", "rank").orderBy("step")
    every = Window.partitionBy("part", "filter")
    return removed.join(totals, ["part", "filter"]).select(
        "part", "filter_order", "step", "filter", (F.col("documents") - F.sum("n").over(so_far)).alias("kept"),
        F.col("n").alias("removed"), (F.col("fails") - F.col("n")).alias("redundant"), "unique_fails",
        F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"), F.sum("n").over(every).alias("shapley"))


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of rules A to D and of E: the text is that of a document with a smaller doc_id.

    Parts are the sources. A document is good (quality 1) or toxic if any
    label row of its doc_id says so. Texts stay where they are read: what is
    joined is a row of doc_id, source, four conditions and the text's SHA-256.
    """
    rules = failures()
    digest = F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256))
    rows = stored(docs.select("doc_id", F.col("source").alias("part"), digest.alias("digest"),
                              *(c.alias(f"fails_{x}") for x, c in rules.items())), "audited")
    known = labels.groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    judged = repeated(rows, "digest", "doc_id").join(known, "doc_id", "left")
    return audit(judged, {**{x: F.col(f"fails_{x}") for x in rules}, "E": F.col("repeat")}, F.col("part"),
                 F.col("good"), F.col("toxic"))
