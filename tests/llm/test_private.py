"""Personal data: patterns against plain regular expressions, messages against enumeration, planted mentions."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from tenderlake.llm import private
from tenderlake.llm.queries import QUERIES

# As the four kinds are worded.
PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for match in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", match[0])
            doubled = "".join(str(int(x) * (1 + k % 2)) if int(x) * (1 + k % 2) < 10 else str(int(x) * 2 - 9)
                              for k, x in enumerate(reversed(digits)))
            good = (True, all(int(p) <= 255 for p in match[0].split(".")) if kind == 1 else True,
                    16 <= len(digits) <= 19 and sum(map(int, doubled)) % 10 == 0, 8 <= len(digits) <= 15)[kind]
            if good:
                out.append((kind, *match.span()))
    return out


def test_base_spans_against_regular_expressions():
    draw = random.Random(3)
    pieces = [*"0123456789", " ", "-", ".", "+", "(", ")", "@", "a", "%", "ü", "+1 ", "4111 1111 1111 1111", "10.0.0.1", "x@y.z",
              "4222222222222", "\n", "٣"]
    for _ in range(4000):
        text = "".join(draw.choices(pieces, k=draw.randrange(1, 40)))
        assert private.base_spans(text) == brute(text), text


def test_long_texts_take_linear_time():
    for text in ("1" * 300_000, "a@" * 150_000, "+1" + " " * 300_000, "1 " * 150_000, "a.b" * 100_000, "1" + ")" * 300_000):
        assert private.base_spans(text) == []
        private.tokens(text)
    assert len(private.base_spans("1." * 150_000)) == 37_500


def graph(n, edges, seed):
    draw = np.random.default_rng(seed)
    field = private.Field(draw.normal(size=(private.FEATURES, 7)), draw.normal(size=(7, 7)), draw.normal(size=(2, 4)))
    return field, private.Lattice(draw.integers(1, 99, (n, 3)), np.array(edges, np.int64).reshape(-1, 3), np.zeros(n, np.int64))


@pytest.mark.parametrize("edges", [[], [(0, 1, 0)], [(0, 1, 0), (1, 2, 0), (0, 3, 1)], [(0, 2, 2), (2, 3, 0), (2, 1, 1)]])
def test_messages_are_exact_without_loops(edges):
    field, lattice = graph(4, edges, len(edges))
    score = field.nodes[lattice.features].sum(axis=1)
    want, pairs = np.zeros((4, 7)), np.zeros((len(edges), 7, 7))
    tables = [field.chain, (field.skip[0] + field.skip[1])[private.RELATION], field.skip[0][private.RELATION]]
    for states in itertools.product(range(7), repeat=4):
        p = np.exp(sum(score[k, s] for k, s in enumerate(states)) + sum(tables[t][states[u], states[v]] for u, v, t in edges))
        for k, s in enumerate(states):
            want[k, s] += p
        for k, (u, v, _) in enumerate(edges):
            pairs[k, states[u], states[v]] += p
    node, edge = private.beliefs(field, lattice, rounds=200, least=1e-10)
    assert np.allclose(node, want / want[0].sum())
    assert np.allclose(edge, pairs / want[0].sum())


def test_loops_settle():
    field, lattice = graph(4, [(0, 1, 0), (1, 2, 0), (2, 3, 0), (0, 3, 1), (0, 2, 2)], 9)
    node, edge = private.beliefs(field, lattice, rounds=200)
    assert np.allclose(node.sum(axis=1), 1) and np.allclose(edge.sum(axis=(1, 2)), 1)
    assert np.allclose(edge[0].sum(axis=1), node[0], atol=1e-2)


def card(draw):
    head = "4" + "".join(draw.choices("0123456789", k=14))
    return next(head + x for x in "0123456789" if private.luhn(head + x))


def mention(draw, kind):
    return {"email": lambda: f"{draw.choice('abcdef')}ou.{draw.randrange(99):02d}@mail{draw.randrange(9)}.example.com",
            "ip": lambda: ".".join(str(draw.randrange(1, 255)) for _ in range(4)), "card": lambda: card(draw),
            "phone": lambda: f"+1 ({draw.randrange(100, 999)}) 555-{draw.randrange(1000, 9999)}"}[kind]()


def text_of(draw, mentions):
    words = [draw.choice(["heth", "onre", "thand", "erbe", "ing", "tion", "the", "of", "y2"]) for _ in range(40)]
    words += [f"no. {draw.randrange(2000)}", f"ref {draw.randrange(10 ** 8):08x}", "v1.2.3", "12.5%", "1990-2004"]
    for m in mentions:
        words.insert(draw.randrange(len(words) + 1), m)
    return " ".join(words)


@pytest.fixture(scope="module")
def field(spark):
    draw = random.Random(7)
    docs = []
    for k in range(400):
        own = [mention(draw, kind) for kind in private.KINDS if draw.random() < 0.4]
        docs.append((k, text_of(draw, own + [m for m in own if draw.random() < 0.4])))
    return private.fit(spark.createDataFrame(docs, "doc_id long, text string"))


def found(spark, field, texts):
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    return {r.id: ([tuple(s) for s in r.base], [tuple(s) for s in r.added]) for r in private.personal_data(frame, field).collect()}


def test_mentions_that_the_patterns_miss(spark, field):
    draw = random.Random(11)
    planted, texts = [], []
    for _ in range(40):
        phone, ip, first, second, mail = (mention(draw, k) for k in ("phone", "ip", "card", "card", "email"))
        obscure = mail.replace("@", "(at)").replace(".example.com", "(dot)example(dot)com")
        joined, clear = text_of(draw, [f"{phone} {ip}", f"{first} {second}", obscure]), text_of(draw, [phone, first, second, mail])
        texts.append(f"{clear} {joined}")
        planted.append({("phone", phone), ("card", first), ("card", second), ("email", obscure)})
    hit = 0
    for k, (base, added) in found(spark, field, texts).items():
        spans = [(kind, texts[k][i:j]) for kind, i, j in added]
        assert [s[:3] for s in base] == [(private.KINDS[a], b, c) for a, b, c in brute(texts[k])]
        assert set(spans) <= planted[k]
        hit += len(set(spans) & planted[k])
    assert hit >= 0.9 * 4 * len(texts)


def test_skip_edges_make_the_difference(field):
    """A token without features of its own is sure by its distant copies, and not without them."""
    draw = random.Random(5)
    for kind, state in (("email", 1), ("ip", 2), ("card", 3)):
        word = mention(draw, kind)
        text = text_of(draw, []) + f" {word} " + text_of(draw, []) + f" {word}; " + text_of(draw, []) + f" {word} end"
        lattice = private.lattice(text, private.tokens(text), [])
        at = [k for k, t in enumerate(private.tokens(text)) if t[2] == word]
        lattice.features[at[1], 2:] = 0
        tied = private.beliefs(field, lattice)[0][at[1], state]
        lattice.edges = lattice.edges[lattice.edges[:, 2] == private.CHAIN]
        alone = private.beliefs(field, lattice)[0][at[1], state]
        assert tied >= private.SURE > alone


def test_clean_texts_stay_clean(spark, field):
    draw = random.Random(13)
    texts = [text_of(draw, []) for _ in range(200)] + ["", " ", "2024", "a@b", "1.2.3", "(1) [2] {3}", "@", "+", "x@"]
    assert all(not base and not added for base, added in found(spark, field, texts).values())


def test_base_stays_and_nothing_overlaps_it(spark, field):
    draw = random.Random(17)
    texts = [text_of(draw, [mention(draw, k) for k in private.KINDS]) for _ in range(50)]
    for k, (base, added) in found(spark, field, texts).items():
        assert [s[:3] for s in base] == [(private.KINDS[a], b, c) for a, b, c in brute(texts[k])]
        assert not any(a < e and s < b for _, a, b in base for _, s, e in added)


def test_odd_rows_and_columns(spark, field):
    rows = [(None, None, 1), (1, None, 2), (1, "", 3), (2, "ö \U0001F600 a@b.c", 4), (2, "ö \U0001F600 a@b.c", 5), (None, "a@b.c", 6),
            (3, "9" * 300_000, 7), (4, "z" * 300_000 + " 10.0.0.1", 8)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, base int").selectExpr("*", "1 AS id", "2 AS added")
    got = sorted(((r.id, [tuple(s) for s in r.base]) for r in private.personal_data(frame, field).collect()), key=repr)
    assert got == sorted([(None, []), (1, []), (1, []), (2, [("email", 4, 9)])] + [(2, [("email", 4, 9)])] + [
        (None, [("email", 0, 5)]), (3, []), (4, [("ip", 300_001, 300_009)])], key=repr)
    none = frame.where("false")
    assert private.personal_data(none, private.fit(none)).collect() == []


def test_registered_query_holds_every_base_span(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op12_personal_data"](spark, folder).collect()}
    assert got.keys() == texts.keys()
    for k, text in texts.items():
        base = brute(text)
        names = [f"{private.KINDS[a]}:{b}:{c}" for a, b, c in base]
        assert [got[k][f"n_{x}"] for x in private.KINDS] == [sum(a == i for a, _, _ in base) for i in range(4)]
        assert got[k].base_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest()
        assert set(names) <= set(filter(None, got[k].spans.split(",")))
