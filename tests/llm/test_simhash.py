import random

import pytest
import xxhash

from tenderlake.llm import simhash
from tenderlake.llm.components import connected_components


def brute_print(text, width=3):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()]
    shingles = [b" ".join(words[i:i + width]) for i in range(len(words) - width + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, distance):
    label = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= distance and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return label


def texts(seed=3, n=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["É", "ß", "Ab"]
    out = []
    for _ in range(n):
        if out and rng.random() < 0.6:
            words = rng.choice(out).split()
            if words and rng.random() < 0.7:
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
        else:
            words = rng.choices(vocabulary, k=rng.choice([1, 2, 3, 40, 400]))
        out.append(" ".join(words))
    return out + ["", " \t\n", None, "One Two", "one two", "x" * 50_000]


def test_matches_brute_force(spark):
    rows = [(i, t, "en", "s") for i, t in enumerate(texts())]
    df = spark.createDataFrame(rows, "doc_id long, text string, key string, rep string").repartition(4)
    got = {r.id: r for r in simhash.near_duplicates(df).collect()}
    prints = {i: brute_print(t) for i, t, *_ in rows}
    assert {i: r.fp0 % (1 << 64) for i, r in got.items()} == prints
    assert {i: r.component for i, r in got.items()} == brute_components(prints, 3)


@pytest.mark.parametrize("bits,distance", [(64, 3), (128, 23), (64, 5)])
def test_links_equal_all_pairs(spark, bits, distance):
    rng = random.Random(bits + distance)
    centre = rng.getrandbits(bits)
    prints = {}
    for i in range(300):  # a dense ball that needs the pivot path, and a chain
        value = centre if i < 200 else rng.getrandbits(bits)
        for b in rng.sample(range(bits), rng.randrange(distance)):
            value ^= 1 << b
        prints.setdefault(value, i)
    for i in range(300, 320):
        value ^= sum(1 << b for b in rng.sample(range(bits), distance))
        prints.setdefault(value, i)
    prints = {i: v for v, i in prints.items()}
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    mask = (1 << 64) - 1
    rows = [(i, *(signed(v >> 64 * k & mask) for k in range(bits // 64))) for i, v in prints.items()]
    classes = spark.createDataFrame(rows, "rep long, " + ", ".join(f"fp{k} long" for k in range(bits // 64)))
    edges = simhash.links(classes, bits, distance)
    assert all((prints[r.a] ^ prints[r.b]).bit_count() <= distance for r in edges.collect())
    label = {i: i for i in prints} | {r.node: r.component for r in connected_components(edges).collect()}
    assert label == brute_components(prints, distance)


def test_empty_and_null_ids(spark):
    kind = "doc_id long, text string, component string"
    assert simhash.near_duplicates(spark.createDataFrame([], kind)).collect() == []
    got = simhash.near_duplicates(spark.createDataFrame([(None, "a b c", "x"), (5, "a b c", "x"), (5, "a b c", "x"),
                                                         (None, "d e f", None)], kind)).collect()
    assert sorted((r.id or -1, r.component or -1) for r in got) == [(-1, -1), (-1, 5), (5, 5), (5, 5)]


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3), (200, 201)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200}
