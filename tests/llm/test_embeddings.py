import numpy as np
import pytest

from tenderlake.llm import embeddings

KIND = "vec_id long, embedding array<float>, label int, rep long"


def data(seed=2, n=700, dims=24):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.5:
            base = np.array(rows[rng.integers(max(0, len(rows) - 40), len(rows))][1])
            v = base + rng.normal(0, rng.choice([0, 0.02, 0.06, 0.09]), dims)
        else:
            v = rng.normal(0, 1, dims)
            v /= np.linalg.norm(v)
        rows.append((int(i * 37 % 5003), [float(np.float32(x)) for x in v], int(rng.integers(3)), 1))
    rows += [(10_000, None, 1, 1), (10_001, [0.0] * dims, 1, 1), (10_002, [float("nan")] * dims, 1, 1),
             (10_003, [None] * dims, 1, 1), (10_004, rows[0][1], None, 1), (10_005, [1.0, 2.0], 1, 1), (10_006, [], 1, 1),
             (10_007, [float("inf")] + [1.0] * (dims - 1), 1, 1)]
    return rows


def brute(rows, threshold=0.93):
    links, label = {r[0]: set() for r in rows}, {r[0]: r[0] for r in rows}
    good = [r for r in rows if r[0] < 10_000]
    x = np.array([r[1] for r in good], np.float32).astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    c = x @ x.T
    for i, j in zip(*np.nonzero(c >= threshold)):
        if i != j and good[i][2] == good[j][2]:
            links[good[i][0]].add(good[j][0])
    moved = True
    while moved:
        moved = False
        for a, to in links.items():
            low = min([label[a], *(label[b] for b in to)])
            for b in (a, *to):
                moved |= label[b] != low
                label[b] = low
    return {r[0]: (len(links[r[0]]), label[r[0]], label[r[0]] == r[0]) for r in rows}


@pytest.mark.parametrize("margin", [0.5, 1.0])
def test_against_brute_force(spark, margin):
    rows = data()
    df = spark.createDataFrame(rows, KIND).repartition(5)
    got = {r.id: (r.n_links, r.component, r.kept) for r in
           embeddings.near_duplicates(df, options=embeddings.Settings(margin=margin)).collect()}
    want = brute(rows)
    recall = sum(min(got[i][0], want[i][0]) for i in want) / sum(w[0] for w in want.values())
    assert all(got[i][0] <= want[i][0] for i in want)
    assert got == want if margin == 1.0 else recall > 0.98


def test_dense_group_is_tiled(spark):
    rng = np.random.default_rng(5)
    v = rng.normal(0, 1, 16)
    rows = [(i, [float(x) for x in np.float32(v + rng.normal(0, 0.01, 16))], 1, 0) for i in range(400)]
    rows += [(1000 + i, rows[0][1], 1, 0) for i in range(50)] + [(2000, rows[0][1], 2, 0), (None, rows[0][1], 1, 0)]
    got = {r.id: (r.n_links, r.component) for r in embeddings.near_duplicates(spark.createDataFrame(rows, KIND)).collect()}
    assert got == {**{r[0]: (449, 0) for r in rows if r[2] == 1 and r[0] is not None}, 2000: (0, 2000), None: (0, None)}


def test_empty(spark):
    assert embeddings.near_duplicates(spark.createDataFrame([], KIND)).collect() == []
    none = spark.createDataFrame([(1, None, 1, 1), (2, [0.0], 1, 1)], KIND)
    assert sorted(tuple(r) for r in embeddings.near_duplicates(none).collect()) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_pairs_across_lists_count_for_both_ends(spark):
    rows = data(seed=8, n=900)
    options = embeddings.Settings(margin=0.5, most_lists=1024)
    got = {r.id: (r.n_links, r.component, r.kept) for r in
           embeddings.near_duplicates(spark.createDataFrame(rows, KIND), options=options).collect()}
    # At half the radius one of two neighbours always probes the other's list.
    assert got == brute(rows)


def test_every_length_links_within_itself(spark):
    long, short = [1.0, 2.0, 3.0], [1.0, 2.0]
    rows = [(1, long, 1, 0), (2, long, 1, 0), (3, [1.0, 2.0, 3.05], 1, 0), (4, short, 1, 0), (5, [1.0, 2.01], 1, 0), (6, short, 2, 0),
            (7, [5.0], 1, 0), (8, [7.0], 1, 0), (9, [-7.0], 1, 0), (10, [0.0], 1, 0)]
    got = {r.id: (r.n_links, r.component) for r in embeddings.near_duplicates(spark.createDataFrame(rows, KIND)).collect()}
    assert got == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (1, 4), 5: (1, 4), 6: (0, 6), 7: (1, 7), 8: (1, 7), 9: (0, 9), 10: (0, 10)}


def test_memory_of_a_dense_list(spark):
    """All pairs of 5,000 vectors of one list are links: far less than a gigabyte is held."""
    import tracemalloc

    import pyarrow as pa

    rng = np.random.default_rng(1)
    n, dims = 5000, 64
    base = rng.normal(size=dims)
    x = base + rng.normal(0, 0.01, (n, dims))
    model = embeddings.fit(embeddings._unit(x[:500]), 1, embeddings.Settings())
    codes, off = model.encode((embeddings._unit(x) - model.centres[0]).astype(np.float32))
    one = pa.table({"label": ["a"] * n, "list": np.zeros(n, np.int32), "role": np.zeros(n, np.int32), "rep": np.arange(n),
                    "copies": np.ones(n, np.int64), "vector": list(x), "code": [c.tobytes() for c in codes], "off": off,
                    "home": np.zeros(n, np.int32), "probes": [[0]] * n})
    both = pa.concat_tables([one, one.set_column(2, "role", pa.array(np.ones(n, np.int32)))])
    tracemalloc.start()
    found = list(embeddings._tile(both, model, float(np.sqrt(0.14)), 0.93))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 500e6
    counts, back, edges = found
    assert (counts[3] == n).all() and len(back[1]) == 0 and len(edges[1]) == n - 1 and (edges[2] == 0).all()
