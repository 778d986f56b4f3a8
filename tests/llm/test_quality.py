import math
import random

import numpy as np
import pytest

from tenderlake.llm import quality

KIND = "doc_id long, text string, quality int, key double"


def rows(n=400):
    rng = random.Random(2)
    good, bad = [f"good{i}" for i in range(60)], [f"junk{i}" for i in range(60)]
    out = []
    for i in range(n):
        fine = rng.random() < 0.7
        out.append((i, " ".join(rng.choices(good if fine else bad, k=rng.randint(3, 60))), int(fine), 0.5))
    return out + [(n, None, None, 0.5), (n + 1, "", 0, 0.5), (n + 1, "", 0, 0.5), (None, "good1 good2", 1, 0.5)]


def brute(data, targets, smoothing=1.0):
    raw, wanted = np.zeros(quality.BUCKETS), np.zeros(quality.BUCKETS)
    found = [quality.bucket_ids((t or "").encode()) for _, t, *_ in data]
    for (i, *_), f in zip(data, found):
        for b in f:
            raw[b] += 1
            wanted[b] += i in targets
    share = lambda x: (x + smoothing) / (x.sum() + smoothing * quality.BUCKETS)
    ratio = np.log(share(wanted) / share(raw))
    return [sum(ratio[b] for b in f) for f in found]


def test_weights_and_draw(spark):
    data = rows()
    df = spark.createDataFrame(data, KIND).repartition(4)
    targets = {i for i, _, q, _ in data if q == 1 and i is not None}
    ratios = quality.log_ratios(df, quality.target_sample(df))
    scored = quality.weigh(df, ratios).collect()
    want = sorted(brute(data, targets))
    assert np.allclose(sorted(r.log_weight for r in scored), want)
    drawn = quality.resample(df, df).collect()
    labelled = [q for *_, q, _ in data if q is not None]
    k = round(sum(labelled) / len(labelled) * len(data))
    assert abs(len(drawn) - k) <= 1
    label = {i: q for i, _, q, _ in data}
    assert np.mean([label[r.doc_id] == 1 for r in drawn if r.doc_id is not None]) > 0.95
    ranked = sorted((r.key for r in scored), reverse=True)
    assert min(r.key for r in drawn) >= ranked[len(drawn) - 1]


def test_noise_is_gumbel(spark):
    docs = spark.range(20_000).select("id", "id").toDF("doc_id", "n").selectExpr("doc_id", "cast(null as string) text")
    noise = [r.key for r in quality.weigh(docs, np.zeros(quality.BUCKETS)).collect()]
    assert abs(np.mean(noise) - 0.5772) < 0.03 and abs(np.var(noise) - math.pi ** 2 / 6) < 0.08


@pytest.mark.parametrize("values", [list(range(9000)), [1.0] * 7000 + [2.0] * 10, [float(i % 3) for i in range(8000)], [5.0]])
def test_top_k(spark, values):
    rng = random.Random(3)
    data = [(i, float(v)) for i, v in enumerate(values)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "doc_id long, key double")
    for k in {0, 1, len(data) // 2, len(data) - 1, len(data), len(data) + 5}:
        want = sorted(data, key=lambda r: (-r[1], r[0]))[:k]
        assert sorted(map(tuple, quality.top_k(df, k).collect())) == sorted(want)


def test_empty(spark):
    none = spark.createDataFrame([], KIND)
    assert quality.resample(none, none).collect() == []
    assert len(quality.resample(spark.createDataFrame([(1, "a", None, 0.0)], KIND), none).collect()) == 1
