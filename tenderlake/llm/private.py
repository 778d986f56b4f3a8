"""Personal data by patterns, and by a skip-chain conditional random field for what the patterns miss.

Four patterns give the base spans of a text. The field labels the tokens that
hold a digit or an at sign. Neighbouring tokens are tied by a linear chain, and
distant tokens of the same key (equal, or the same last digits, or the same
address in another spelling) by skip edges, so that a clear mention decides
about an unclear one. Sums over the loopy graph are passed as messages. The
weights are learned from the base spans of a bounded sample, and from more
mentions of them in other writings. Some tokens lose their own features there,
as they would otherwise tell everything and leave nothing to the edges.
"""

from __future__ import annotations

import functools
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake.llm.common import binary_text, text_batches, text_bytes

KINDS = ("email", "ip", "card", "phone")
#: States of a token: outside, whole address, whole number, begin and inside of what may have several tokens.
STATES = ("O", "email", "ip", "card", "card+", "phone", "phone+")
KIND_OF = np.array([0, 1, 2, 3, 3, 4, 4])
BEGIN, INSIDE = {"email": 1, "ip": 2, "card": 3, "phone": 5}, {"card": 4, "phone": 6}

# Patterns of the base spans. Runs are possessive and numbers start where a run of digits does: the same matches, in
# linear time.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NO_DIGIT = re.compile(r"[^0-9]+")

#: Least probability of a label that adds a span, and fewest digits of one.
SURE, DIGITS = 0.9, {"email": 0, "ip": 4, "card": 12, "phone": 7}
#: Documents looked at for training, those kept at most, and their longest text.
SAMPLE, MOST, LONGEST_TEXT = 40_000, 4_000, 50_000
FEATURES, WIDTH, LONGEST = 1 << 12, 16, 254


def luhn(digits: str) -> bool:
    total = 0
    for k, x in enumerate(reversed(digits)):
        v = ord(x) - 48
        total += v if k % 2 == 0 else 2 * v - 9 * (v > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by code points, by kind and then by start; those failing the kind's check are left out."""
    found = []
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            free = match.end()
            found.append((0, start, free))
        at = text.find("@", max(at + 1, free))
    for match in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in match[0].split(".")):
            found.append((1, *match.span()))
    for match in CARD.finditer(text):
        if match.end() - match.start() >= 16:
            digits = NO_DIGIT.sub("", match[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append((2, *match.span()))
    for match in PHONE.finditer(text):
        if 8 <= len(NO_DIGIT.sub("", match[0])) <= 15:
            found.append((3, *match.span()))
    return found


SIGN = re.compile(r"[0-9@]")
ALLOWED = LOCAL | frozenset("@()[]")
RIGHT = re.compile(r"[A-Za-z0-9._%+\-@()\[\]]*+")
GAP = re.compile(r"[\x20().,/-]{1,3}")
OBSCURE_AT, OBSCURE_DOT = re.compile(r"[(\[]at[)\]]", re.IGNORECASE), re.compile(r"[(\[]dot[)\]]", re.IGNORECASE)


def tokens(text: str) -> list[tuple[int, int, str]]:
    """(start, end, text) of the tokens with a digit or an at sign, without punctuation around them.

    Runs of more than ``LONGEST`` characters are no mention of any kind.
    """
    out, match, free = [], SIGN.search(text), 0
    while match:
        start = match.start()
        while start > free and text[start - 1] in ALLOWED:
            start -= 1
        free = end = RIGHT.match(text, match.start()).end()
        if end - start <= LONGEST:
            while text[start] in ".-_%)]":
                start += 1
            while text[end - 1] in ".-_%+([" or text[end - 1] == ")" and "(" not in text[start:end]:
                end -= 1
            out.append((start, end, text[start:end]))
        match = SIGN.search(text, free)
    return out


def key_of(word: str) -> str | None:
    """Tokens of one key are taken for mentions of the same thing."""
    if "@" in word or "[" in word or "(" in word and OBSCURE_AT.search(word):
        plain = OBSCURE_DOT.sub(".", OBSCURE_AT.sub("@", word)).lower()
        if "@" in plain:
            return "@" + plain
    if re.search("[A-Za-z]", word):
        return None
    digits = NO_DIGIT.sub("", word)
    return digits[-7:] if len(digits) >= 7 else None


@functools.lru_cache(maxsize=1 << 16)
def _index(name: str) -> int:
    return 1 + zlib.crc32(name.encode()) % (FEATURES - 1)


@functools.lru_cache(maxsize=1 << 16)
def _shape(word: str) -> tuple[str, int, tuple[str, ...]]:
    """Coarse shape, number of digits, and own features of a token."""
    digits = NO_DIGIT.sub("", word)
    n, letters = len(digits), re.sub("[^A-Za-z]", "", word)
    size = n if n <= 4 else {5: 5, 6: 5, 7: 7, 8: 8, 9: 8, 10: 10, 11: 11, 12: 11}.get(n, 13 if n < 16 else 16 if n < 20 else 20)
    kind = "-" if not letters else "x" if re.fullmatch("[a-fA-F]+", letters) else "w"
    parts = word.split(".")
    quad = len(parts) == 4 and all(p.isdigit() for p in parts) and 1 + all(len(p) < 4 and int(p) < 256 for p in parts)
    mail = "@" in word and 1 + bool(re.fullmatch(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", word))
    shape = f"{word[0] if word[0] in '+(' else ''}{size}{kind}{int(quad)}{int(mail)}"
    check = 16 <= n <= 19 and kind == "-" and luhn(digits)
    return shape, n, (f"size {size} {kind}", f"quad {int(quad)}", f"mail {int(mail)}", f"first {word[0] in '+('} {word[0]}",
                      f"hyphen {'-' in word.strip('-')}", f"check {check} {size}", f"shape {shape}")


@dataclass
class Lattice:
    """Tokens of documents as a graph: node features, edges (u, v, type), and states where they are known."""

    features: np.ndarray
    edges: np.ndarray
    states: np.ndarray

    @staticmethod
    def joined(parts: list[Lattice]) -> Lattice:
        first = np.cumsum([0] + [len(p.features) for p in parts])
        return Lattice(np.concatenate([p.features for p in parts]),
                       np.concatenate([p.edges + np.array([n, n, 0]) for p, n in zip(parts, first)]),
                       np.concatenate([p.states for p in parts]))


#: Types of edges: neighbours, skip between equal tokens, skip between similar ones.
CHAIN, EQUAL, SIMILAR = 0, 1, 2


def lattice(text: str, found: list[tuple[int, int, str]], spans: list[tuple[int, int, int]]) -> Lattice:
    n = len(found)
    near = [k + 1 < n and bool(GAP.fullmatch(text, found[k][1], found[k + 1][0])) for k in range(n)]
    shapes = [_shape(w) for _, _, w in found]
    runs: list[str] = [""] * n
    begin = 0
    for k in range(n):
        if not near[k]:
            numeric = [NO_DIGIT.sub("", found[i][2]) for i in range(begin, k + 1) if not re.search("[A-Za-z@.+]", found[i][2])]
            digits = "".join(numeric) if k > begin else ""
            told = f"run {min(len(digits), 20)} {16 <= len(digits) <= 19 and luhn(digits)}"
            runs[begin:k + 1] = [told] * (k + 1 - begin)
            begin = k + 1
    features = np.zeros((n, WIDTH), np.int64)
    for k, (shape, _, own) in enumerate(shapes):
        left = shapes[k - 1][0] if k and near[k - 1] else "^"
        right = shapes[k + 1][0] if near[k] else "$"
        row = ("bias", *own, runs[k], f"left {left}", f"right {right}", f"left {left} {shape}", f"right {shape} {right}",
               f"both {left} {shape} {right}", f"alone {left == '^' and right == '$'} {shape}")
        features[k, :len(row)] = [_index(x) for x in row]
    edges = [(k, k + 1, CHAIN) for k in range(n - 1) if near[k]]
    last: dict[str, int] = {}
    for k, (_, _, word) in enumerate(found):
        key = key_of(word)
        if key is not None:
            if key in last:
                edges.append((last[key], k, EQUAL if found[last[key]][2] == word else SIMILAR))
            last[key] = k
    states = np.zeros(n, np.int64)
    for kind, start, end in sorted(spans, reverse=True):
        for i, k in enumerate(_overlapping(found, start, end)):
            states[k] = BEGIN[KINDS[kind]] if i == 0 else INSIDE.get(KINDS[kind], BEGIN[KINDS[kind]])
    return Lattice(features, np.array(edges, np.int64).reshape(-1, 3), states)


def _overlapping(found: list[tuple[int, int, str]], start: int, end: int) -> Iterator[int]:
    low, high = 0, len(found)
    while low < high:
        middle = (low + high) // 2
        if found[middle][1] <= start:
            low = middle + 1
        else:
            high = middle
    while low < len(found) and found[low][0] < end:
        yield low
        low += 1


@dataclass
class Field:
    """Weights: of features by state, of neighbouring states, and of skip edges by how their two kinds relate.

    The first row of ``skip`` holds for all skip edges, the second is added for equal tokens.
    """

    nodes: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    @staticmethod
    def zero() -> Field:
        return Field(np.zeros((FEATURES, len(STATES))), np.zeros((len(STATES),) * 2), np.zeros((2, 4)))


#: How two kinds relate: both outside, one outside, the same, different.
RELATION = np.where(KIND_OF[:, None] == KIND_OF, np.where(KIND_OF[:, None] == 0, 0, 2),
                    np.where((KIND_OF[:, None] == 0) | (KIND_OF == 0), 1, 3))


def _scatter(values: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(at, values[:, s], n) for s in range(values.shape[1])], axis=1)


def _sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis)


def beliefs(field: Field, graph: Lattice, rounds: int = 25, least: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of the states of each node and of each edge, by sum-product messages in log space.

    Exact where the graph has no loop of edges, if ``rounds`` are as many as
    its longest path; messages are halfway mixed with the last ones.
    """
    n, edges = len(graph.features), graph.edges
    score = field.nodes[graph.features].sum(axis=1)
    tables = np.stack([field.chain, field.skip.sum(axis=0)[RELATION], field.skip[0][RELATION]])
    pair = tables[edges[:, 2]]
    both = np.concatenate([pair, pair.transpose(0, 2, 1)])
    source, target = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
    m, sent = len(edges), np.zeros((2 * len(edges), score.shape[1]))
    back = np.concatenate([np.arange(m, 2 * m), np.arange(m)])
    for k in range(rounds if m else 0):
        cavity = (score + _scatter(sent, target, n))[source] - sent[back]
        new = _sum(cavity[:, :, None] + both, 1)
        new -= _sum(new, 1)[:, None]
        new = new if k == 0 else (new + sent) / 2
        change = np.abs(new - sent).max()
        sent = new
        if change < least:
            break
    total = score + (_scatter(sent, target, n) if m else 0)
    node = np.exp(total - _sum(total, 1)[:, None]) if n else total
    cavity = total[source] - sent[back]
    edge = cavity[:m, :, None] + cavity[m:, None, :] + pair
    edge = np.exp(edge - _sum(edge.reshape(m, -1), 1)[:, None, None]) if m else edge
    return node, edge


def train(graph: Lattice, steps: int = 60, rate: float = 0.15, decay: float = 1e-4) -> Field:
    """Weights that raise the likelihood of the known states (Adam on gradients from the beliefs)."""
    field = Field.zero()
    n, edges = len(graph.features), graph.edges
    if not n or not graph.states.any():
        return field
    eye = np.eye(len(STATES))
    flat, repeat = graph.features.ravel(), graph.features.shape[1]
    pairs = eye[graph.states[edges[:, 0]]][:, :, None] * eye[graph.states[edges[:, 1]]][:, None, :]
    weights = [field.nodes, field.chain, field.skip]
    first, second = ([np.zeros_like(w) for w in weights] for _ in range(2))
    for step in range(1, steps + 1):
        node, edge = beliefs(field, graph, rounds=8)
        off = (eye[graph.states] - node) / n
        gradient = [_scatter(np.repeat(off, repeat, axis=0), flat, FEATURES), None, np.zeros((2, 4))]
        away = (pairs - edge) / n
        gradient[1] = away[edges[:, 2] == CHAIN].sum(axis=0)
        for k, own in enumerate((edges[:, 2] != CHAIN, edges[:, 2] == EQUAL)):
            gradient[2][k] = np.bincount(RELATION.ravel(), away[own].sum(axis=0).ravel(), 4)
        for w, g, a, b in zip(weights, gradient, first, second):
            g -= decay * w
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            w += rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-8)
        field.nodes[0] = 0  # padding
    return field


def _hidden(graph: Lattice, seed: int) -> Lattice:
    """The lattice with only two coarse features left of some tokens: three in ten of those with a skip edge, else one."""
    tied = np.zeros(len(graph.features), bool)
    tied[graph.edges[graph.edges[:, 2] != CHAIN][:, :2].ravel()] = True
    drop = np.random.default_rng(seed).random(len(tied)) < np.where(tied, 0.3, 0.1)
    features = graph.features.copy()
    features[drop, 2:] = 0
    return Lattice(features, graph.edges, graph.states)


def rewritten(text: str, spans: list[tuple[int, int, int]], seed: int) -> tuple[str, list[tuple[int, int, int]]]:
    """The text with more mentions behind it, of which the spans are known: most of them in writings no pattern takes.

    Addresses are spelled with (at) and (dot); numbers lose their country code,
    are grouped by points, or run into other numbers, which are no mention.
    """
    draw = random.Random(seed)
    number = lambda: "".join(draw.choices("0123456789", k=draw.choice((3, 4, 5, 8, 9))))
    parts, out, at = [text], list(spans), len(text)

    def put(piece: str, kind: int | None = None) -> None:
        nonlocal at
        if kind is not None:
            out.append((kind, at, at + len(piece)))
        parts.append(piece)
        at += len(piece)

    for kind, start, end in draw.sample(spans, min(len(spans), 12)):
        mention = text[start:end]
        put(draw.choice((" and ", ".\n", " ")))
        if kind == 0:
            local, _, domain = mention.partition("@")
            sign, dot = draw.choice((("(at)", "."), ("[at]", "."), ("(at)", "(dot)"), ("[at]", "[dot]"), ("@", ".")))
            put(local + sign + domain.replace(".", dot), kind)
        elif kind == 1:
            put(mention, kind)
        else:
            if kind == 3 and draw.random() < 0.3 and " " in mention:
                mention = mention[mention.index(" ") + 1:]
            elif draw.random() < 0.3:
                mention = re.sub("[ -]", ".", re.sub("[()]", "", mention))
            before, after = draw.random() < 0.4, draw.random() < 0.6
            if before:
                put(number() + " ")
            put(mention, kind)
            if after:
                other = draw.choice(spans)
                put(" ")
                put(text[other[1]:other[2]], other[0]) if draw.random() < 0.6 else put(number())
    return "".join(parts), out


def lessons(text: str, seed: int) -> Lattice | None:
    """What a text teaches: its tokens, and those of its rewritten form. None without a token.

    Where a pattern ran over several numbers and so failed its check, it does
    not tell that they are no mentions; those tokens are left out.
    """
    spans = base_spans(text)
    unclear = [m.span() for pattern in (CARD, PHONE) for m in pattern.finditer(text)
               if len(NO_DIGIT.sub("", m[0])) >= 8 and not any(s < m.end() and m.start() < e for _, s, e in spans)]

    def taught(body: str, known: list[tuple[int, int, int]]) -> Lattice:
        return lattice(body, [t for t in tokens(body) if not any(s < t[1] and t[0] < e for s, e in unclear)], known)

    graphs = [taught(text, spans)] + ([taught(*rewritten(text, spans, seed))] if spans else [])
    graph = Lattice.joined(graphs)
    return graph if len(graph.features) else None


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Field:
    """A field learned from the base spans of a sample.

    About ``SAMPLE`` documents are looked at, chosen by the hash of their id;
    of those with a token at most ``MOST``, of up to ``LONGEST_TEXT``
    characters. The driver receives their feature numbers, no texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches):
            rows = []
            for order, data in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
                text = data.decode()
                graph = lessons(text, order) if len(text) <= LONGEST_TEXT and SIGN.search(text) else None
                if graph:
                    rows.append((order, graph.features.astype("<u2").tobytes(), graph.edges.astype("<u4").tobytes(),
                                 graph.states.astype(np.uint8).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64())] + [
                pa.array([r[k] for r in rows], pa.binary()) for k in (1, 2, 3)], ["place", "features", "edges", "states"])

    rows = docs.select(F.xxhash64(id_col).alias("place"), binary_text(text_col).alias("text"))
    one_of = max(1, docs.count() // SAMPLE)
    kept = rows.where(F.pmod("place", F.lit(one_of)) == 0).mapInArrow(
        run, "place long, features binary, edges binary, states binary").orderBy("place", "features", "edges").limit(MOST)
    parts = []
    for place, features, edges, states in zip(*(c.to_pylist() for c in kept.toArrow().columns)):
        graph = Lattice(np.frombuffer(features, "<u2").reshape(-1, WIDTH).astype(np.int64),
                        np.frombuffer(edges, "<u4").reshape(-1, 3).astype(np.int64), np.frombuffer(states, np.uint8).astype(np.int64))
        parts += [graph, _hidden(graph, place & 0xFFFFFFFF)]
    return train(Lattice.joined(parts)) if parts else Field.zero()


def added_spans(text: str, found: list[tuple[int, int, str]], graph: Lattice, node: np.ndarray,
                base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of sure labels that touch no base span."""
    state, sure = node.argmax(axis=1), node.max(axis=1) >= SURE
    near = set(graph.edges[graph.edges[:, 2] == CHAIN][:, 0].tolist())
    out, k, n = [], 0, len(found)
    taken = sorted((s, e) for _, s, e in base)
    while k < n:
        kind = KIND_OF[state[k]] - 1
        last = k
        if kind < 0 or not sure[k]:
            k += 1
            continue
        inside = INSIDE.get(KINDS[kind], -1)
        while last in near and state[last + 1] == inside and sure[last + 1]:
            last += 1
        start, end = found[k][0], found[last][1]
        while kind and start < end and text[start] not in "+(0123456789":
            start += 1
        while kind and start < end and not "0" <= text[end - 1] <= "9":
            end -= 1
        digits = len(NO_DIGIT.sub("", text[start:end]))
        spelled = kind > 0 or "@" in (key_of(found[k][2]) or "")
        if spelled and digits >= DIGITS[KINDS[kind]] and not any(s < end and start < e for s, e in taken):
            out.append((int(kind), start, end))
        k = last + 1
    return out


def personal_data(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, added) of every row: arrays of (kind, start, end), code points of the whole text, end exclusive.

    base: what the patterns find, by kind (email, ip, card, phone) and start.
    added: what the field finds beside it. A null text is empty; rows of equal
    or null id are judged each for itself.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def spans(rows: list[list[tuple[int, int, int]]]) -> pa.Array:
        flat = [s for r in rows for s in r]
        members = pa.StructArray.from_arrays([pa.array([KINDS[s[0]] for s in flat], pa.string())] + [
            pa.array([s[k] for s in flat], pa.int64()) for k in (1, 2)], ["kind", "start", "end"])
        return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, rows)]), pa.int32()), members)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in text_batches(batches):
            base, added, graphs, owners = [], [], [], []
            for k, data in enumerate(text_bytes(batch.column(1))):
                text = data.decode()
                words = tokens(text)
                base.append(base_spans(text) if words else [])
                added.append([])
                if words:
                    owners.append((k, text, words))
                    graphs.append(lattice(text, words, []))
            if graphs:
                node, _ = beliefs(model, Lattice.joined(graphs))
                first = 0
                for (k, text, words), graph in zip(owners, graphs):
                    added[k] = added_spans(text, words, graph, node[first:first + len(words)], base[k])
                    first += len(words)
            yield pa.RecordBatch.from_arrays([batch.column(0), spans(base), spans(added)], ["id", "base", "added"])

    kind = docs.schema[id_col].dataType.simpleString()
    struct = "array<struct<kind:string,start:bigint,end:bigint>>"
    return docs.select(F.col(id_col).alias("id"), binary_text(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, base {struct}, added {struct}")
