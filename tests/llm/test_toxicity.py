import random
import zlib

import numpy as np

from tenderlake.llm import toxicity

BAD = ["stupidfool", "wretchgrim", "hatespeak"]


def corpus(n=1500, seed=1):
    rng = random.Random(seed)
    syllables = ["ba", "re", "lo", "ti", "mu", "sen", "dor", "ka", "vi", "pol"]
    words = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(800)]
    docs = []
    for i in range(n):
        text = rng.choices(words, k=rng.randint(20, 120))
        toxic = rng.random() < 0.3
        if toxic:
            for _ in range(max(2, len(text) // 25)):
                text[rng.randrange(len(text))] = rng.choice(BAD)
        docs.append((i, " ".join(text), int(toxic), "score"))
    return docs


def test_held_out_accuracy_and_misspellings(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int, score string").repartition(6)
    docs, labels = df.drop("toxic"), df.select("doc_id", "toxic")
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r for r in toxicity.scores(docs.withColumn("held", toxicity.held_out()), model).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert {i for i, r in got.items() if r.held} == {r[0] for r in held}
    assert np.mean([(got[r[0]].score >= 0.5) == r[2] for r in held]) > 0.97
    clean = [r[1] for r in held if not r[2]]
    misspelt = [(t + " stupidfooll wretchgrimm hatespeakk" * 3).encode() for t in clean]
    assert np.mean([model.score(t) > 0.5 for t in misspelt]) > 0.9
    assert np.array_equal(model.weights, toxicity.fit(docs.repartition(2), labels).weights)  # order does not matter


def test_odd_rows(spark):
    kind = "doc_id long, text string, toxic int"
    rows = [(1, None, 1), (2, "", 0), (None, "x", 1), (4, "a b", None), (5, "w" * 600_000, 0), (5, "w" * 600_000, 1)]
    df = spark.createDataFrame(rows, kind)
    model = toxicity.fit(df, df)
    got = toxicity.scores(df, model).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if not r.text}) == 1
    empty = spark.createDataFrame([], kind)
    none = toxicity.fit(empty, empty)
    assert toxicity.scores(empty, none).collect() == [] and toxicity.scores(df, none).first().score < 0.5


def test_pieces_cover_the_text_once():
    rng = random.Random(4)
    text = " ".join("".join(rng.choices("abcdé", k=rng.randint(1, 9))) for _ in range(3000)).encode()
    whole = np.sort(np.concatenate(list(toxicity.buckets(text))))
    old, toxicity.PIECE = toxicity.PIECE, 50
    try:
        pieces = list(toxicity.buckets(text))
    finally:
        toxicity.PIECE = old
    assert len(pieces) > 100 and np.array_equal(whole, np.sort(np.concatenate(pieces)))
