"""Cleaning pipeline over ``documents``: the stages are applied in order, each to what the one before kept.

Every stage takes ``(spark, docs, sf_dir)``. All but the last return the
columns of ``docs``. Rows without doc_id cannot be named by a join, so the
near-duplicate stage leaves them alone; the other stages judge them like any
other row. Null texts count as empty. What a stage has written on the way is
deleted when its output is stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.llm import decontamination, packing, shingles, suffixes, toxicity
from tenderlake.llm.common import made, release, stored, table

#: Near duplicates: words of a shingle; sets of shingles with a similarity of 0.8 or more are linked.
SHINGLE = 5
#: Bytes of a repeated string: some fifteen words.
REPEAT = 100


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more go. The model learns from the labels of documents that are there."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    # The score goes to a column of its own, so that one of this name in ``docs`` stays.
    scored = toxicity.scores(docs, model, "toxicity_score")
    return scored.where("toxicity_score < 0.5").drop("toxicity_score")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest doc_id."""
    found = shingles.near_duplicates(docs, SHINGLE)
    drop = stored(found.where("id <> component").select(F.col("id").alias("doc_id")).distinct(), "near-copies")
    return docs.join(drop, "doc_id", "left_anti").select(docs.columns)


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings that an earlier document has are cut out of the texts.

    Characters cut in two go with them. A document of which nothing but white
    space is left was a copy, and goes; n_chars follows the text.
    """
    others = F.struct(*[c for c in docs.columns if c != "text"]).alias("row")
    found = suffixes.remove_repeats(docs.select(others, "doc_id", "text"), REPEAT)
    left = F.regexp_replace(F.make_valid_utf8(F.col("kept").cast("string")), "�", "")
    text = F.when(F.col("n_removed") > 0, left).otherwise(F.col("text"))
    rows = found.select("row.*", text.alias("text_left"), "n_removed").where(
        (F.col("n_removed") == 0) | F.col("text_left").rlike(r"\S"))
    length = F.when(F.col("n_removed") > 0, F.char_length("text_left")).otherwise(F.col("n_chars")).cast("long")
    new = {"text": F.col("text_left").alias("text"), "n_chars": length.alias("n_chars")}
    return rows.select(*(new.get(c, c) for c in docs.columns))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ten consecutive words of a benchmark item, or with the whole of a shorter one, go."""
    found = decontamination.contamination(docs, table(spark, sf_dir, "benchmark"))
    bad = stored(found.where("contaminated").select("key").distinct(), "contaminated")
    keyed = docs.withColumn("row_key", decontamination.row_key("doc_id", "text"))
    return keyed.join(bad, keyed.row_key == bad.key, "left_anti").select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Batches of documents padded to tokens of a bucket: doc_id, n_tokens, bucket, bucket_length, batch, slot."""
    return packing.pack(docs).withColumnRenamed("id", "doc_id")


STAGES = [("toxicity", reject_toxic), ("simhash_dedup", near_duplicates), ("suffix_dedup", remove_repeats),
          ("decontamination", decontaminate), ("packing", pack)]

#: A trained model, iterated components and a dynamic program have no SQL form; tests hold the stages against
#: brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mark = made()
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
        release(docs, mark)
    return docs
