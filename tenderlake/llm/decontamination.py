"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations only.

Windows of consecutive item words are sets of shingles. A text contains a
window only if it contains the window's rarest shingle, so one shingle of each
window is joined (its prefix), the window is placed around it, kept if it fits
into the text, and verified word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderlake.llm.common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What separates words once A-Z are lower-cased: everything in ASCII but digits and a-z.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SHINGLE = 3
#: Distinct benchmark shingles (one 64-bit number each) that may be sent to every task: 8 MB.
BROADCAST_SHINGLES = 1_000_000


def words(text: str = "text") -> Column:
    """Words of a text; null has none."""
    lowered = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, BETWEEN), "")


def _shingles(word_array: Column, size: int) -> Column:
    """Hash of the ``size`` words from each place on; fewer places than words."""
    return F.transform(F.sequence(F.lit(0), F.size(word_array) - size),
                       lambda i: F.xxhash64(*(F.get(word_array, i + k) for k in range(size))))


def windows(benchmark: DataFrame, width: int = 10) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (window, text, n) and their items (window, item_id).

    window is the hash of its text; an item of fewer words than ``width`` is
    one window, an item without words none.
    """
    item = benchmark.select("item_id", words().alias("w")).where(F.size("w") > 0)
    length = F.least(F.size("w"), F.lit(width))
    cut = item.select("item_id", length.alias("n"), F.explode(F.transform(
        F.sequence(F.lit(1), F.size("w") - length + 1), lambda i: F.array_join(F.slice("w", i, length), " "))).alias("text"))
    cut = stored(cut.select("item_id", "n", "text", F.xxhash64("text").alias("window")).distinct(), "windows")
    return cut.select("window", "text", "n").distinct(), cut.select("window", "item_id").distinct()


def _window_shingles(cut: DataFrame) -> DataFrame:
    """(window, n, text, offset, size, shingle) of each shingle of each window."""
    parts = cut.withColumn("w", F.split("text", " ")).withColumn("size", F.least("n", F.lit(SHINGLE)))
    out = None
    for size in range(1, SHINGLE + 1):
        one = parts.where(F.col("size") == size).select("window", "n", "text", "size",
                                                        F.posexplode(_shingles(F.col("w"), size)).alias("offset", "shingle"))
        out = one if out is None else out.unionAll(one)
    return out


def _occurrences(docs: DataFrame, shingles: DataFrame, sizes: list[int]) -> DataFrame:
    """(key, place, shingle, size) wherever a text has one of ``shingles``."""
    split = docs.select("key", words().alias("w"))
    found = None
    for size in sizes:
        one = split.where(F.size("w") >= size).select("key", F.posexplode(_shingles(F.col("w"), size)).alias(
            "place", "shingle")).withColumn("size", F.lit(size))
        found = one if found is None else found.unionAll(one)
    wanted = shingles.select("shingle", "size").distinct()
    if wanted.count() <= BROADCAST_SHINGLES:
        wanted = F.broadcast(wanted)
    return found.join(wanted, ["shingle", "size"])


def row_key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col), F.col(text_col))


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = 10, id_col: str = "doc_id") -> DataFrame:
    """For every row: key (of ``row_key``), id, n_words, n_hit, n_items, items (sorted as strings), contaminated.

    A word inside any occurrence of a window is hit. items are those with an
    occurring window. Texts are read twice: for their shingles, and for the
    word by word check. Rows are told apart by id and text, so repeated rows
    give repeated results and null ids are no obstacle.
    """
    keyed = docs.select(F.col(id_col).alias("id"), F.col("text"), row_key(id_col, "text").alias("key"))
    cut, items = windows(benchmark, width)
    shingles = stored(_window_shingles(cut), "window-shingles")
    sizes = [r["size"] for r in shingles.select("size").distinct().collect()]  # three at most
    if not sizes:
        none = F.array().cast("array<string>")
        return keyed.select("key", "id", F.size(words()).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"),
                            F.lit(0).cast("long").alias("n_items"), none.alias("items"),
                            F.lit(False).alias("contaminated"))

    found = stored(_occurrences(keyed, shingles, sizes), "occurrences")
    rarity = found.groupBy("shingle", "size").agg(F.count("*").alias("times"))
    # A window of which some shingle occurs nowhere occurs nowhere: no inner join partner for its rarest shingle.
    ranked = shingles.join(rarity, ["shingle", "size"], "left").groupBy("window", "n", "text").agg(F.min(F.struct(
        F.coalesce("times", F.lit(0)).alias("times"), "shingle", "offset", "size")).alias("prefix"))
    prefixes = stored(ranked.where("prefix.times > 0").select(
        "window", "n", "text", "prefix.shingle", "prefix.offset", "prefix.size"), "prefixes")
    candidates = stored(found.join(prefixes, ["shingle", "size"]).where("place >= offset").select(
        "key", (F.col("place") - F.col("offset")).alias("start"), "n", "text", "window").distinct().groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("start", "n", "text", "window"))).alias("tried")), "candidates")
    split = keyed.select("id", "key", words().alias("w"))
    tried = F.coalesce("tried", F.array().cast(candidates.schema["tried"].dataType))
    hits = F.filter(tried, lambda c: (c["start"] + c["n"] <= F.size("w")) & (
        F.array_join(F.slice(F.col("w"), c["start"] + 1, c["n"]), " ") == c["text"]))
    checked = split.join(candidates, "key", "left").select(
        "id", "key", F.size("w").cast("long").alias("n_words"), hits.alias("hits"))
    # Hits are in order of their start: each adds what reaches beyond the end covered so far.
    begin = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    covered = F.aggregate("hits", begin, lambda seen, h: F.struct(
        F.greatest(seen["end"], h["start"] + h["n"]).alias("end"),
        (seen["n"] + F.greatest(F.lit(0), h["start"] + h["n"] - F.greatest(seen["end"], h["start"]))).alias("n")))
    result = stored(checked.select("id", "key", "n_words", covered["n"].cast("long").alias("n_hit"), F.array_distinct(
        F.transform("hits", lambda h: h["window"])).alias("windows")), "checked")
    of_key = result.where("n_hit > 0").select("key", F.explode("windows").alias("window")).distinct().join(
        items, "window").select("key", F.col("item_id").cast("string").alias("item")).distinct().groupBy("key").agg(
        F.sort_array(F.collect_list("item")).alias("items"))
    names = F.coalesce("items", F.array().cast("array<string>"))
    return result.join(stored(of_key, "doc-items"), "key", "left").select(
        "key", "id", "n_words", "n_hit", F.size(names).cast("long").alias("n_items"), names.alias("items"),
        (F.col("n_hit") > 0).alias("contaminated"))
