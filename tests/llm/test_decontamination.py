import random
import re

from tenderlake.llm import decontamination

KIND = "doc_id long, text string, item_id long, n long"


def brute_words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(docs, items, width=10):
    cut = {}
    for item, text in items:
        w = brute_words(text)
        n = min(width, len(w))
        for i in range(len(w) - n + 1) if n else ():
            cut.setdefault(tuple(w[i:i + n]), set()).add(str(item))
    out = []
    for doc, text in docs:
        w, hit, names = brute_words(text), set(), set()
        for n in {len(c) for c in cut}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in cut:
                    hit.update(range(i, i + n))
                    names |= cut[tuple(w[i:i + n])]
        out.append((doc, len(w), len(hit), len(names), tuple(sorted(names)), bool(hit)))
    return sorted(out, key=repr)


def run(spark, docs, items):
    d = spark.createDataFrame([(*r, None, 1) for r in docs], KIND).repartition(4)
    b = spark.createDataFrame([(None, t, i, 2) for i, t in items], KIND)
    return sorted((tuple(r[1:5]) + (tuple(r[5]), r[6]) for r in decontamination.contamination(d, b).collect()), key=repr)


def test_against_brute_force(spark):
    rng = random.Random(6)
    vocabulary = ["the", "of", "a", "b", "É", "é", "ß", "x1"] + [f"w{i}" for i in range(40)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 3, 5, 9, 10, 11, 30])))) for i in range(30)]
    items += [(40, items[4][1]), (41, None), (42, "!!"), (43, ""), (9, "Same words, of the Item here now and then also then"),
              (9, "The. OF"), (None, "w1 w2 w3 w4")]
    docs = []
    for i in range(150):
        w = rng.choices(vocabulary, k=rng.choice([0, 1, 5, 40, 200]))
        for _ in range(rng.randrange(3)):
            part = brute_words(rng.choice(items)[1])
            at = rng.randrange(len(w) + 1)
            w[at:at] = part[:rng.randint(0, len(part))] if rng.random() < 0.4 else part
        docs.append((i, rng.choice([" ", "-", ".\n"]).join(x.upper() if rng.random() < 0.2 and x.isascii() else x for x in w)))
    docs += [(3, docs[3][1]), (3, docs[4][1]), (None, docs[5][1]), (None, None), (200, None), (201, "")]
    docs += [(202, "the of " * 20_000 + "same words of the item here now and then also then")]
    items_named = [(i if i is not None else 99, t) for i, t in items]
    assert run(spark, docs, items_named) == brute(docs, items_named)


def test_empty(spark):
    assert run(spark, [], [(1, "a b")]) == []
    assert run(spark, [(1, "a b")], []) == [(1, 2, 0, 0, (), False)]
    assert run(spark, [(1, "a b")], [(1, "...")]) == [(1, 2, 0, 0, (), False)]


def test_join_of_many_shingles(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BROADCAST_SHINGLES", 0)
    docs, items = [(1, "one two three four five")], [(5, "two three"), (6, "four six")]
    assert run(spark, docs, items) == brute(docs, items)


def test_plan_is_native(spark):
    df = spark.createDataFrame([(1, "a b c", 1, 1)], KIND)
    plan = decontamination.contamination(df, df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
