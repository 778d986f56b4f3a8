"""Merkle manifests against a tree that is built whole."""

import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tenderlake.llm import merkle


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(nodes, fan):
    """Root and, for each node, its siblings (left, right) level by level."""
    paths, levels = [[] for _ in nodes], [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        above, below = [], []
        for at in range(0, len(nodes), fan):
            run = nodes[at:at + fan]
            for k, leaves in enumerate(levels[at:at + fan]):
                for i in leaves:
                    paths[i].append(("".join(run[:k]), "".join(run[k + 1:])))
            above.append(h(*run))
            below.append([i for part in levels[at:at + fan] for i in part])
        nodes, levels = above, below
    return nodes[0], paths


def whole(groups, fan):
    """groups: {name: leaves in order} -> {name: (subroot, root, witnesses)}."""
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    built = {g: tree(groups[g], fan) for g in names}
    root, top = tree([built[g][0] for g in names], fan)
    return {g: (built[g][0], root, [p + top[k] for p in built[g][1]]) for k, g in enumerate(names)}


@pytest.mark.parametrize("fan,depth,sizes", [
    (2, 1, {"a": 13, None: 1, "b": 2, "é": 7, "Z": 4}), (3, 2, {"a": 100, "b": 9, "c": 10, "d": 1}), (8, 4, {"a": 4097, "b": 65, "c": 9}),
    (2, 2, {f"g{k}": 1 + k % 3 for k in range(40)}), (8, 4, {None: 1})])
def test_against_a_whole_tree(spark, fan, depth, sizes):
    leaves = [(g, k, h(f"{g} {k}")) for g, n in sizes.items() for k in range(n)]
    random.Random(1).shuffle(leaves)
    found = merkle.manifest(spark.createDataFrame(leaves, "g string, k long, leaf string").repartition(5), "g", ["k"], fan, depth)
    want = whole({g: [h(f"{g} {k}") for k in range(n)] for g, n in sizes.items()}, fan)
    got = found.collect()
    assert len(got) == len(leaves)
    for r in got:
        subroot, root, paths = want[r.grp]
        assert r.position == r.row.k and (r.subroot, r.root) == (subroot, root)
        assert [tuple(s) for s in r.witness] == paths[r.position]


def test_witness_folds_to_the_root_and_no_other_leaf_does(spark):
    leaves = spark.createDataFrame([("g", k, h(str(k))) for k in range(70)], "g string, k long, leaf string")
    found = merkle.manifest(leaves, "g", ["k"])
    other = F.sha2(F.col("node"), 256)
    good, bad = found.select(F.min(merkle.folded(F.col("node"), F.col("witness")) == F.col("root")),
                             F.max(merkle.folded(other, F.col("witness")) == F.col("root"))).first()
    assert good and not bad


def brute(docs):
    """Rows of the check as the tampering is worded, keyed by leaf, which ties share."""
    kept = {}
    for doc_id, lang, source, n, text in docs:
        head = field(doc_id) + field(source) + field(lang) + field(n)
        leaf = h(head + field(text))
        lower = None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
        kept.setdefault(lang, []).append(((doc_id is not None, doc_id or 0, leaf), doc_id, leaf, h(head + field(lower)) if hit else leaf))
    for rows in kept.values():
        rows.sort()
    want = whole({g: [r[2] for r in rows] for g, rows in kept.items()}, 8)
    out = []
    for g, rows in kept.items():
        subroot, root, paths = want[g]
        for (_, doc_id, leaf, now), path in zip(rows, paths):
            for left, right in path:
                now = h(left, now, right)
            out.append((doc_id, leaf, subroot, root, h("".join(x + y for x, y in path)), now, now == root))
    return sorted(out, key=repr)


SCHEMA = "doc_id long, lang string, source string, n_chars long, text string"


def checked(spark, docs):
    frame = spark.createDataFrame(docs, SCHEMA).selectExpr("*", "'x' AS leaf", "1 AS row", "2 AS position", "3 AS total")
    return sorted((tuple(r) for r in merkle.check_tampering(frame.repartition(3)).collect()), key=repr)


def test_tampering_against_brute_force(spark):
    draw = random.Random(2)
    docs = [(draw.choice([None, *range(-20, 200)]), draw.choice([None, "", "en", "en", "en", "dé", "\U0001F600", "￿"]),
             draw.choice([None, "", "s"]), draw.choice([None, 0, -5, 10 ** 12]), draw.choice([None, "", "ÄB c", "abc", "Z" * 5000, "x:1-"]))
            for _ in range(300)]
    docs += docs[:40]
    assert checked(spark, docs) == brute(docs)


def test_no_rows_and_one_row(spark):
    assert checked(spark, []) == []
    got, = checked(spark, [(0, None, None, None, None)])
    assert got[1] == got[2] == got[3] and got[4] == h("") and got[6] is True


def test_many_equal_rows(spark):
    docs = [(5, "en", "s", 1, "Same")] * 3000 + [(k, "en", "s", 1, "Other") for k in range(100)]
    assert checked(spark, docs) == brute(docs)


def test_proof_digest_of_steps(spark):
    steps = spark.sql("SELECT array(named_struct('left', 'a', 'right', 'b'), named_struct('left', '', 'right', 'c')) AS w")
    assert steps.select(merkle.proof_digest(F.col("w"))).first()[0] == h("abc")
