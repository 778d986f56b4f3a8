"""Near copies of the pipeline's second stage."""

import random

import numpy as np
import pyarrow as pa

import corpus_pipeline as pipeline
from tenderlake.llm import shingles as near
from tenderlake.llm import simhash

KIND = "doc_id long, text string"


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def similarity(x, y):
    x, y = shingles(x), shingles(y)
    return len(x & y) / len(x | y)


def kept(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), KIND).repartition(4)
    return {r.doc_id for r in pipeline.near_duplicates(spark, docs, "").collect()}


def pairs_without_close_segment(n):
    """Texts of similarity 0.8 or more and 16 to 23 differing bits, all 16-bit segments of which differ in two or more."""
    rng, out = random.Random(4), []
    while len(out) < n:
        words = [f"v{rng.randrange(10 ** 6)}" for _ in range(104)]
        other = list(words)
        for k in (30, 70):
            other[k] = f"v{rng.randrange(10 ** 6)}"
        prints = [simhash.fingerprint(simhash.shingle_hashes(" ".join(w).encode(), 5, 128)) for w in (words, other)]
        apart = np.bitwise_count((prints[0] ^ prints[1]).view(np.uint16))
        if apart.sum() <= 23 and apart.min() >= 2:
            out.append((" ".join(words), " ".join(other)))
    return out


def test_pairs_up_to_the_bound_are_found(spark):
    texts = [t for pair in pairs_without_close_segment(4) for t in pair]
    assert all(similarity(x, y) >= 0.8 for x, y in zip(texts[::2], texts[1::2]))
    assert kept(spark, texts) == set(range(0, len(texts), 2))


def groups(texts):
    """Smallest member of each text's group, by all pairs."""
    sets, label = [shingles(t or "") for t in texts], list(range(len(texts)))
    linked = lambda x, y: len(x & y) >= 0.8 * len(x | y)
    for i in range(len(texts)):
        for j in range(i):
            if label[i] != label[j] and linked(sets[i], sets[j]):
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return label


def test_links_are_decided_by_the_shingle_sets(spark):
    rng, texts = random.Random(8), []
    word = lambda: f"v{rng.randrange(10 ** 6)}"
    for _ in range(60):
        words = [word() for _ in range(rng.randint(5, 160))]
        texts.append(" ".join(words))
        for _ in range(rng.randint(0, 3)):
            for _ in range(rng.randint(1, 4)):
                words[rng.randrange(len(words))] = word()
            texts.append(" ".join(words))
    texts += [" ".join(word() for _ in range(6)) for _ in range(150)] + [None, "", " \t", "one", "ONE", "one two"]
    want = {i for i, x in enumerate(groups(texts)) if i == x}
    assert len(texts) - len(want) > 30
    assert kept(spark, texts) == want


def test_dense_groups_are_whole(spark, monkeypatch):
    monkeypatch.setattr(near, "BULK", 4)
    monkeypatch.setattr(near, "PIVOTS", 1)
    rng = random.Random(9)
    word = lambda: f"v{rng.randrange(10 ** 6)}"
    base, texts = [word() for _ in range(104)], []
    for _ in range(90):  # copies of one text with two or three words changed, around the bound to each other
        words = list(base)
        for k in rng.sample(range(104), rng.choice([1, 2, 3])):
            words[k] = word()
        texts.append(" ".join(words))
    label = groups(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), KIND).repartition(4)
    assert {r.id: r.component for r in near.near_duplicates(docs).collect()} == dict(enumerate(label))


def test_rows_of_one_id_and_without_id(spark):
    texts = [(3, "a b c d e f"), (3, "p q r s t u"), (5, "p q r s t u"), (None, "a b c d e f"), (2, "a b c d e f")]
    found = near.near_duplicates(spark.createDataFrame(texts, KIND)).collect()
    assert sorted((r.id, r.component) for r in found) == [(2, 2), (3, 2), (3, 2), (5, 2)]


def test_counts_by_cell_keep_texts_apart_and_lose_no_link():
    rng = random.Random(11)
    word = lambda: f"v{rng.randrange(10 ** 6)}"
    base, sets = [word() for _ in range(400)], []
    for k in range(80):  # 60 copies with seven words changed, some 0.7 like each other, and 20 with one or two
        words = list(base)
        for at in rng.sample(range(10, 390, 6), 7 if k < 60 else rng.choice([1, 2])):
            words[at] = word()
        sets.append(near.shingle_set(" ".join(words).encode(), 5))
    sets.append(near.shingle_set(" ".join(word() for _ in range(9000)).encode(), 5))
    sets.append(np.delete(sets[-1], [5, 6]))  # every cell is full in both
    rows = [(1, k, len(s), 0, k, near.cell_counts(s)) for k, s in enumerate(sets)]
    part = pa.table(dict(zip(("key", "rep", "n", "pos", "label", "cells"), map(list, zip(*rows)))))
    i, j = np.triu_indices(len(sets), 1)
    found = set(zip(*(x.tolist() for x in near.Members(part).candidates(i, j))))
    links = {(a, b) for a, b in zip(i.tolist(), j.tolist())
             if near.similar(len(np.intersect1d(sets[a], sets[b])), len(sets[a]), len(sets[b]))}
    assert links <= found and (80, 81) in found
    apart = [p for p in found if p[1] < 60]
    assert len(apart) < 0.1 * 60 * 59 / 2
