import random

from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from tenderlake.llm.encoding import tokenizer_path

KIND = "doc_id long, text string, lang string, source string, n_chars long"


def planted(seed=5):
    rng = random.Random(seed)
    syllables = ["ba", "re", "lo", "ti", "mu", "sen", "dor", "ka", "vi", "pol", "é"]
    words = lambda n: [("".join(rng.choices(syllables, k=rng.randint(1, 4)))) for _ in range(n)]
    clean = [" ".join(words(rng.randint(60, 200))) for _ in range(300)]
    toxic = []
    for _ in range(90):
        w = words(100)
        for _ in range(6):
            w[rng.randrange(100)] = rng.choice(["stupidfool", "wretchgrim", "hatespeak"])
        toxic.append(" ".join(w))
    copies = clean[:10] + [t.rsplit(" ", 1)[0] + " changed" for t in clean[10:20]]
    passage = " ".join(words(60))
    passages = [" ".join(words(40)) + " " + passage + " " + " ".join(words(40)) for _ in range(5)]
    items = [" ".join(words(25)) for _ in range(5)]
    leaks = [" ".join(words(30)) + " " + "".join(c.upper() if c.isascii() else c for c in t) + ", " + " ".join(words(30)) for t in items]
    return clean, toxic, copies, passage, passages, items, leaks


def test_planted_cases(spark, tmp_path):
    clean, toxic, copies, passage, passages, items, leaks = planted()
    texts = clean + toxic + copies + passages + leaks + [None, "", "x"]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, KIND).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, int(300 <= i < 390)) for i in range(390) if i % 3]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in pipeline.STAGES:
        docs = pipeline.stored(stage(spark, docs, str(tmp_path)), name)
        kept[name] = {r.doc_id: r for r in docs.collect()}
        if name != "packing":
            assert docs.dtypes == spark.createDataFrame([], KIND).dtypes
    first = lambda n, size: set(range(n, n + size))
    assert len(first(300, 90) & kept["toxicity"].keys()) <= 3
    assert len(kept["toxicity"].keys() & first(0, 300)) >= 297
    near = kept["simhash_dedup"].keys()
    assert not near & first(390, 20)
    assert near >= (kept["toxicity"].keys() - first(390, 20)) - {len(texts) - 2, len(texts) - 3}
    suffix = kept["suffix_dedup"]
    assert passage in suffix[410].text and all(passage not in suffix[i].text for i in range(411, 415))
    assert all(r.text == texts[i] for i, r in suffix.items() if i < 300)
    assert all(r.n_chars == len(r.text) for i, r in suffix.items() if r.text is not None)
    assert kept["decontamination"].keys() == suffix.keys() - first(415, 5)
    assert kept["packing"].keys() == kept["decontamination"].keys()


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], KIND).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert pipeline.run(spark, str(tmp_path)).collect() == []


def test_odd_rows_and_columns(spark, tmp_path):
    names = KIND + ", key long, score double, `order` int, kept string, id string, row int"
    rows = [(i, t, None, None, None, 1, 2.0, 3, "k", "i", 4) for i, t in [
        (1, None), (2, ""), (None, "a b c"), (None, "a b c"), (3, "w" * 300_000), (4, "same text here"), (4, "same text here")]]
    spark.createDataFrame(rows, names).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(None, None, None), (2, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "w"), (None, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in pipeline.STAGES:
        docs = pipeline.stored(stage(spark, docs, str(tmp_path)), name)
    got = sorted((r.doc_id or -1, r.n_tokens) for r in docs.collect())
    count = lambda t: len(Tokenizer.from_file(tokenizer_path()).encode(t, add_special_tokens=False).ids)
    same = count("same text here")
    assert got == [(-1, 3), (-1, 3), (1, 0), (3, count("w" * 300_000)), (4, same), (4, same)]
