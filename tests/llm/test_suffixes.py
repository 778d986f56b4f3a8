import hashlib
import random

import numpy as np
import pytest

from tenderlake.llm import hashing, suffixes

KIND = "doc_id long, text string, removed long, order string"


def brute(rows, length):
    firsts = {}
    for doc, text, *_ in rows:
        data = (text or "").encode()
        doc = suffixes.LAST if doc is None else doc
        for i in range(len(data) - length + 1):
            s = data[i:i + length]
            firsts[s] = min(firsts.get(s, doc), doc)
    out = []
    for doc, text, *_ in rows:
        data = (text or "").encode()
        order = suffixes.LAST if doc is None else doc
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - length + 1):
            if firsts[data[i:i + length]] < order:
                gone[i:i + length] = True
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((doc, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows, length):
    df = spark.createDataFrame(rows, KIND).repartition(5)
    found = suffixes.remove_repeats(df, length).collect()
    assert all(len(r.kept) == r.n_bytes - r.n_removed for r in found)
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.removed), r.kept_sha256) for r in found), key=repr)


def corpus(seed, alphabet, n=80):
    rng = random.Random(seed)
    made, rows = [], []
    for i in range(n):
        text = "".join(rng.choices(alphabet, k=rng.choice([0, 10, 49, 50, 51, 60, 200, 900])))
        for _ in range(rng.randrange(4)):
            if made:
                source = rng.choice(made)
                a = rng.randrange(len(source) + 1)
                b = a + rng.choice([20, 48, 49, 50, 51, 52, 90, 300, 2000])
                at = rng.randrange(len(text) + 1)
                text = text[:at] + source[a:b] + text[at:]
        if made and rng.random() < 0.2:
            text = rng.choice(made)
        made.append(text)
        rows.append((rng.randrange(10_000), text, 1, "x"))
    return rows


@pytest.mark.parametrize("seed,alphabet,length", [(1, "abcdefghijé ", 50), (2, "ab", 50), (3, "aé", 50), (4, "abcdefgh", 100)])
def test_against_brute_force(spark, seed, alphabet, length):
    rows = corpus(seed, alphabet)
    rows += [(None, rows[0][1], 0, "x"), (None, rows[3][1] + "z", 0, ""), (5, None, 0, ""), (rows[1][0], rows[2][1], 0, ""),
             (7, "=" * 3000, 0, ""), (8, "=" * 49, 0, ""), (9, "=" * 5000, 0, ""), rows[9], rows[9]]
    assert run(spark, rows, length) == brute(rows, length)


def test_empty_and_lonely(spark):
    assert run(spark, [], 50) == []
    assert run(spark, [(1, "a" * 500, 0, "")], 50) == [(1, 500, 0, 0, hashlib.sha256(b"a" * 500).hexdigest())]


def test_mergesort_and_extensions():
    rng = random.Random(4)
    groups = np.sort(np.array([rng.randrange(12) for _ in range(400)]))
    strings = [bytes(rng.choices(b"ab", k=rng.randrange(0, 20))) for _ in groups]
    sizes = np.array([len(s) for s in strings])
    s = suffixes.Suffixes(np.frombuffer(b"".join(strings), np.uint8), np.cumsum(sizes) - sizes, sizes)
    got = s.sort(groups)
    want = sorted(range(400), key=lambda k: (groups[k], strings[k]))
    assert [(groups[k], strings[k]) for k in got] == [(groups[k], strings[k]) for k in want]
    rows = np.zeros((400, 20), np.uint8)
    for k, x in enumerate(strings):
        rows[k, :len(x)] = list(x)
    order, common = suffixes._runs(rows, sizes, groups)
    for k in range(1, 400):
        a, b = strings[order[k - 1]], strings[order[k]]
        n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert common[k] == (n if groups[order[k]] == groups[order[k - 1]] else -1)


def test_collisions_are_found_out(monkeypatch):
    monkeypatch.setattr(hashing, "_tables", [np.zeros(1 << 16, np.uint64), np.zeros(1 << 16, np.uint64)])  # all hashes 0
    rng = random.Random(4)
    rows = np.array([[rng.choice(b"ab") for _ in range(9)] for _ in range(60)], np.uint8)
    sizes, groups = np.full(60, 9), np.zeros(60, np.int64)
    order, common = suffixes._runs(rows, sizes, groups)
    assert [bytes(rows[k]) for k in order] == sorted(map(bytes, rows))


def test_surroundings_of_one_hash_are_told_apart(monkeypatch):
    """With a hash of two bits nearly all surroundings collide; groups are still those of equal bytes."""
    rng = random.Random(6)
    texts = [("".join(rng.choices("ab", k=rng.randrange(60, 120)))).encode() for _ in range(12)]
    texts += [texts[0], texts[3][10:], b"x" + texts[5]]
    layout = suffixes.Layout(50, 24)
    block = object.__new__(suffixes.Block)
    block.octets = np.frombuffer(b"".join(texts), np.uint8)
    block.orders = np.arange(len(texts))
    block.ends = np.cumsum([len(t) for t in texts])
    block.starts = block.ends - [len(t) for t in texts]
    place, _ = suffixes.anchors(block.octets, block.starts, block.ends, layout)
    order = np.searchsorted(block.ends, place, side="right")
    monkeypatch.setattr(hashing, "mixed", lambda v: v & np.uint64(3))
    seen = block.surroundings(order, place - block.starts[order], layout)
    windows = suffixes._window(block.octets, seen["place"], seen["left"], seen["right"], layout)
    content = [(w.tobytes(), a, b) for w, a, b in zip(windows, seen["left"], seen["right"])]
    assert len(set(content)) == len(set(seen["group"])) == len(set(zip(content, seen["group"])))
    assert len(set(seen["hash"])) == len(set(content)) < len(content)
    again = block.surroundings(order[::-1], (place - block.starts[order])[::-1], layout)
    assert np.array_equal(again["hash"], seen["hash"][::-1])


def test_one_name_for_different_surroundings_of_two_blocks():
    layout = suffixes.Layout(50, 24)
    same, other = b"a" * 50, b"a" * 20 + b"b" + b"a" * 29  # one gram, one name, other bytes behind
    reach = layout.length - layout.gram

    def rows(number, order, body):
        head = suffixes._blob(np.array([7], np.uint64), np.array([order]), np.array([0], np.uint8), np.array([reach], np.uint8))
        return b"".join([np.array([number, len(head), len(body)], "<i8").tobytes(), head,
                         suffixes.pa.compress(body, "zstd", asbytes=True)])

    part = suffixes.pa.Table.from_batches([suffixes._rows([0] * 3, "around", [rows(1, 5, same), rows(2, 6, other), rows(3, 9, same)])])
    found = suffixes._repeats(layout)(part)
    marks = dict(zip(found.column("part").to_pylist(), found.column("data")))
    assert set(marks) == {3}  # only the later copy of equal bytes
