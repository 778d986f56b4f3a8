import random
from collections import Counter, defaultdict
from itertools import combinations

import pytest

from tokenizers import Tokenizer

from tenderlake.llm import packing
from tenderlake.llm.encoding import tokenizer_path


def tokens(text):
    return len(Tokenizer.from_file(tokenizer_path()).encode(text or "", add_special_tokens=False).ids)


def padding(lengths, ends):
    return sum(min(e for e in ends if e >= n) - n for n in lengths)


@pytest.mark.parametrize("seed", range(8))
def test_borders_are_optimal(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([0, 1, 2, 3, 7, 8, 20, 21, 22, 50, 400, 401]) for _ in range(rng.randint(1, 60))]
    cells = [(n, c, n * c) for n, c in sorted(Counter(lengths).items())]
    distinct = [n for n, *_ in cells]
    for buckets in (1, 2, 3, 5, 20):
        k = min(buckets, len(distinct))
        least = min(padding(lengths, [*c, distinct[-1]]) for c in combinations(distinct[:-1], k - 1))
        ends = packing.borders(cells, buckets)
        assert len(ends) <= buckets and padding(lengths, ends) == least


def test_batches(spark):
    rng = random.Random(1)
    rows = [(i, "w " * rng.choice([0, 1, 5, 6, 6, 6, 40, 90, 3000]), 9) for i in range(500)]
    rows += [(None, None, 9), (7, "a b", 9), (7, "a b", 9), (1000, "x " * 9000, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, bucket int").repartition(5)
    old, packing.SLICE_ROWS = packing.SLICE_ROWS, 40
    try:
        got = packing.pack(df, buckets=4, budget=300).collect()
    finally:
        packing.SLICE_ROWS = old
    assert Counter((r.id, r.n_tokens) for r in got) == Counter((i, tokens(t)) for i, t, _ in rows)
    lengths = [r.n_tokens for r in got]
    cells = [(n, c, n * c) for n, c in sorted(Counter(lengths).items())]
    ends = packing.borders(cells, 4)
    batches = defaultdict(list)
    for r in got:
        assert r.bucket_length == ends[r.bucket] and r.bucket == packing.bucket_of(r.n_tokens, ends)
        batches[r.bucket, r.batch].append(r)
    for (bucket, batch), own in batches.items():
        room = max(1, 300 // max(ends[bucket], 1))
        assert sorted(r.slot for r in own) == list(range(len(own))) and len(own) <= room
        assert len(own) == room or batch == max(b for k, b in batches if k == bucket)


def test_long_lengths_have_borders_of_their_own(spark):
    rng = random.Random(4)
    lengths = [rng.choice([1, 4097, 4098, 4099, 5000, 90_001, 90_002, 90_007, 1_000_003]) for _ in range(90)]
    df = spark.createDataFrame(list(enumerate(lengths)), "doc_id long, n int")
    from pyspark.sql import functions as F
    got = packing.pack(df, buckets=4, length=F.col("n")).collect()
    distinct = sorted(set(lengths))
    least = min(padding(lengths, [*c, distinct[-1]]) for c in combinations(distinct[:-1], 3))
    assert sum(r.bucket_length - r.n_tokens for r in got) == least


def test_lengths_of_odd_rows(spark):
    rows = [(None, "a b"), (1, None), (1, None), (2, ""), (3, " x"), (4, "w" * 300_000), (5, "two  spaces\t and"), (6, "é" * 10)]
    df = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, n_tokens int")
    got = Counter((r.doc_id, r.n_tokens) for r in packing.token_lengths(df).collect())
    assert got == Counter((i, tokens(t)) for i, t in rows)
    assert packing.token_lengths(df.where("false")).collect() == []


def test_empty(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    assert packing.borders([], 3) == []
