"""Filter interaction audit against a document-by-document replay of every order."""

import random
import re
from itertools import permutations

import pytest

from tenderlake.llm import audit

COLUMNS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def fails(docs):
    """Letters that each (doc_id, source, text) fails, by the rules as they are worded."""
    out = []
    for doc_id, _, text in docs:
        text = text or ""
        words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
        letters = {x for x, bad in {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), "D": re.search("[#$%&*|]", text),
            "E": doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, _, t in docs)}.items() if bad}
        out.append(letters)
    return out


def replay(docs, labels):
    good, toxic = ({r[0] for r in labels if r[k] == 1} for k in (1, 2))
    rows, failed = [], fails(docs)
    for part in {s or "" for _, s, _ in docs}:
        own = [(d, f) for d, f in zip(docs, failed) if (d[1] or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        steps = []
        for order in map("".join, permutations("ABCDE")):
            left = list(own)
            for step, x in enumerate(order, 1):
                taken = [d for d, f in left if x in f]
                left = [(d, f) for d, f in left if x not in f]
                shapley[x] += len(taken)
                steps.append([part, order, step, len(left), len(taken), sum(x in f for _, f in own) - len(taken),
                              sum(f == {x} for _, f in own), sum(d[0] in good for d in taken), sum(d[0] in toxic for d in taken)])
        rows += [tuple(s) + (shapley[s[1][s[2] - 1]],) for s in steps]
    return sorted(rows)


def result(spark, docs, labels):
    found = audit.audit_documents(
        spark.createDataFrame(docs, "doc_id long, source string, text string").selectExpr("*", "1 AS mask", "'x' AS part"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "0 AS good"))
    return sorted(tuple(r) for r in found.select(*COLUMNS).collect())


def test_against_replay(spark):
    draw = random.Random(5)
    texts = [None, "", "#", "A" * 9, " ".join(f"w{k}" for k in range(250)), "aa " * 300, "bb|" + " cc dd" * 150,
             "Alpha\x0bBeta\tGamma " * 90, " ".join(f"Über{k}" for k in range(220)), "ß " * 201 + "Q" * 9, "\x85".join("xyz")]
    docs = [(draw.choice([None, *range(60)]), draw.choice([None, "", "src0", "src1", "hot", "hot", "hot"]), draw.choice(texts))
            for _ in range(150)]
    labels = [(draw.choice([None, *range(60)]), draw.choice([None, 0, 1]), draw.choice([None, 0, 1])) for _ in range(60)]
    assert result(spark, docs, labels) == replay(docs, labels)


def test_one_clean_document_gives_zeros(spark):
    text = " ".join(f"word{k}" for k in range(200))
    got = result(spark, [(1, "a", text)], [])
    assert len(got) == 600 and all(r[3] == 1 and not any(r[4:]) for r in got)


def test_copies_by_the_thousand_and_repeated_rows(spark):
    docs = [(k, "s", "copy") for k in range(1500)] + [(0, "s", "copy"), (7, None, "copy")]
    assert result(spark, docs, [(3, 1, 1)]) == replay_fast(docs, [(3, 1, 1)])


def replay_fast(docs, labels):
    """The replay with one representative per behaviour; counts scaled by hand: short copies fail A, later ones E too."""
    first = sum(d[0] == 0 for d in docs if d[1] == "s")
    rows = []
    for part, n, clean in (("s", sum(d[1] == "s" for d in docs), first), ("", 1, 0)):
        for order in map("".join, permutations("ABCDE")):
            early = order.index("E") < order.index("A")
            for step, x in enumerate(order, 1):
                before = set(order[:step - 1])
                taken = {"A": clean if early else n, "E": n - clean if early else 0}.get(x, 0)
                fail = {"A": n, "E": n - clean}.get(x, 0)
                gone = sum({"A": clean if early else n, "E": n - clean if early else 0}.get(y, 0) for y in before | {x})
                lost = int(part == "s" and (x == "E" and early or x == "A" and not early))
                rows.append((part, order, step, n - gone, taken, fail - taken, clean if x == "A" else 0, lost, lost,
                             {"A": 60 * n + 60 * clean, "E": 60 * (n - clean)}.get(x, 0)))
    return sorted(rows)


def test_empty_table(spark):
    assert result(spark, [], [(1, 1, 1)]) == []


@pytest.mark.parametrize("letters", ["A", "AB", "ABC", "ABCDE"])
def test_intervals_cover_each_removal_once(letters):
    orders, hit = audit.orders(letters), {}
    for mask, step, first, end in audit.intervals(letters):
        for rank in range(first, end):
            assert hit.setdefault((mask, rank), step) == step
    for mask in range(1, 1 << len(letters)):
        inside = {x for k, x in enumerate(letters) if mask >> k & 1}
        for rank, order in enumerate(orders):
            assert hit[mask, rank] == next(k for k, x in enumerate(order, 1) if x in inside)


def test_more_filters_of_any_kind(spark):
    rows = spark.createDataFrame([("p", k) for k in range(30)], "p string, k int")
    from pyspark.sql import functions as F
    found = audit.audit(rows, {"X": F.col("k") % 2 == 0, "Y": F.col("k") % 3 == 0}, F.col("p"), F.lit(None), F.lit(False))
    got = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.shapley) for r in found.collect()}
    assert got == {("XY", 1): (15, 15, 0, 10, 25), ("XY", 2): (10, 5, 5, 5, 15),
                   ("YX", 1): (20, 10, 0, 5, 15), ("YX", 2): (10, 10, 5, 10, 25)}
