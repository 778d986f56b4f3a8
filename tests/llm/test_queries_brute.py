"""Registered queries over the given tables against plain versions of their contracts."""

import hashlib
import random
import re

import numpy as np
import xxhash
from test_embeddings import brute as linked
from test_suffixes import brute as cut

from tenderlake.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def documents(spark, folder=SF_DIR):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}


def fingerprint(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split("[\x20\x09-\x0d]+", lower) if w]
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_op1(spark):
    prints = {i: fingerprint(t) for i, t in documents(spark).items()}
    label = {i: i for i in prints}
    for i in sorted(prints):
        for j in prints:
            if label[i] != label[j] and (prints[i] ^ prints[j]).bit_count() <= 3:
                low, high = sorted((label[i], label[j]))
                label = {k: low if v == high else v for k, v in label.items()}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op1_simhash"](spark, SF_DIR).collect()}
    assert got == {i: (f"{p:016x}", label[i]) for i, p in prints.items()}
    assert len(set(label.values())) < len(label)


def test_op3(spark):
    docs = documents(spark)
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op3_suffix_dedup"](spark, SF_DIR).collect()),
                 key=repr)
    assert got == cut(list(docs.items()), 50) and any(r[2] for r in got)


def test_op5_with_planted_neighbours(spark, tmp_path):
    given = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    rows = given.collect()
    rng = random.Random(3)
    planted = []
    for k, r in enumerate(rng.sample(rows, 40)):
        near = np.array(r.embedding) + np.random.default_rng(k).normal(0, rng.choice([0.0, 0.01, 0.03]), len(r.embedding))
        planted.append(r.asDict() | {"vec_id": 1_000_000 + k, "embedding": [float(x) for x in near]})
    frame = given.unionByName(spark.createDataFrame(planted, given.schema))
    frame.write.parquet(f"{tmp_path}/embeddings.parquet")
    # The plain version takes ids from 10,000 on for vectors without links: number the rows anew, in order.
    every = sorted(frame.collect(), key=lambda r: r.vec_id)
    number = {r.vec_id: k for k, r in enumerate(every)}
    want = linked([(number[r.vec_id], r.embedding, r.label, 0) for r in every])
    got = {number[r.vec_id]: (r.n_links, number[r.component_id], r.kept) for r in QUERIES["op5_embedding_dedup"](spark, str(tmp_path)).collect()}
    assert got == want and sum(w[0] > 0 for w in want.values()) >= 60


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split("[\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower) if w]


def test_op7(spark):
    windows = {}
    for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect():
        item = words(r.text)
        for i in range(max(1, len(item) - 9) if item else 0):
            windows.setdefault(tuple(item[i:i + 10]), set()).add(str(r.item_id))
    sizes = {len(w) for w in windows}
    got = {r.doc_id: r for r in QUERIES["op7_decontamination"](spark, SF_DIR).collect()}
    for doc, text in documents(spark).items():
        own, hit, items = words(text), set(), set()
        for n in sizes:
            for i in range(len(own) - n + 1):
                if tuple(own[i:i + n]) in windows:
                    hit |= set(range(i, i + n))
                    items |= windows[tuple(own[i:i + n])]
        row = got[doc]
        assert (row.n_words, row.n_hit, row.n_items, row.contaminated) == (len(own), len(hit), len(items), bool(hit))
        assert row.items_sha256 == hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
    assert any(r.contaminated for r in got.values())
