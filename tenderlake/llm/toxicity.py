"""Toxicity by averaged subword embeddings and a linear softmax, trained together.

A text is the bag of the byte n-grams of its words, spaces marking word ends,
and of the words themselves, hashed to ``BUCKETS`` embedding rows. Their mean
goes through one linear layer. A misspelling never seen shares most n-grams,
and so most of its embedding, with the word it came from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenderlake.llm import hashing
from tenderlake.llm.common import binary_text, give_back, text_batches, text_bytes

BITS = 16
BUCKETS = 1 << BITS
GRAMS = (3, 4, 5)
#: Zero rows counted into every mean, so that a few n-grams of a very short text do not decide alone.
DAMPING = 200
#: Bytes of a text hashed in one pass.
PIECE = 1 << 18


@dataclass
class Training:
    """Settings of the fit. Rows of each class are bounded; they are those of the smallest hashed ids."""

    max_toxic: int = 1500
    max_clean: int = 3500
    dimensions: int = 4
    epochs: int = 8
    batch: int = 64
    rate: float = 0.3
    gain: float = 30.0
    floor: float = 1e-6
    clean_weight: float = 3.0
    seed: int = 7


def buckets(text: bytes) -> Iterator[np.ndarray]:
    """Buckets of all n-grams and words of a text, piece by piece; repeats included."""
    octets, spaces = hashing.spaced_words(text)
    if len(octets) < 3:  # no word
        return
    at = 0
    while at < len(spaces) - 1:
        # A piece ends at the last space before its bound, or at the end of one longer word.
        stop = max(int(np.searchsorted(spaces, spaces[at] + PIECE, side="right")) - 1, at + 1)
        part = octets[spaces[at]:spaces[stop] + 1]
        own = spaces[at:stop + 1] - spaces[at]
        sums = hashing.prefix(part)
        before = np.zeros(len(part) + 1, np.int32)
        np.cumsum(part == 32, out=before[1:])
        found = [hashing.substrings(sums, own[:-1], own[1:] + 1)]
        for n in GRAMS:
            if len(part) >= n:
                last = len(part) - n + 1
                inner = before[n - 1:n - 1 + last] == before[1:1 + last]  # no space inside the gram
                found.append(hashing.windows(sums, n)[inner])
        yield (hashing.mixed(np.concatenate(found)) >> np.uint64(64 - BITS)).astype(np.int64)
        at = stop


def bag(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and how often each occurs."""
    counts = np.zeros(BUCKETS, np.int64)
    for found in buckets(text):
        counts += np.bincount(found, minlength=BUCKETS)
    own = np.flatnonzero(counts)
    return own.astype(np.uint16), counts[own].astype(np.uint32)


def damped(counts: np.ndarray) -> np.ndarray:
    """Share of each bucket in the mean. Repeats count by their logarithm: a line repeated over and over says it once."""
    weight = np.log1p(counts)
    return weight / (weight.sum() + DAMPING)


@dataclass
class Model:
    """What each bucket adds to the log-odds of a text, times its share, and the log-odds of an empty text."""

    weights: np.ndarray
    bias: float

    def score(self, text: bytes) -> float:
        own, counts = bag(text)
        odds = self.bias + float(self.weights[own] @ damped(counts))
        return float(1 / (1 + np.exp(-np.clip(odds, -700, 700))))


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, options: Training) -> Model:
    """Fit embeddings and softmax layer together by Adagrad on batches of bags."""
    share = (labels.sum() + 0.5) / (len(labels) + 1) if len(labels) else 0.0
    if not len(labels) or labels.min() == labels.max():  # nothing to tell apart
        return Model(np.zeros(BUCKETS, np.float32), float(np.log(max(share, 1e-3) / (1 - min(share, 0.999)))))
    rng = np.random.default_rng(options.seed)
    # Rows start at zero, so that n-grams never met say nothing.
    table = np.zeros((BUCKETS, options.dimensions), np.float32)
    layer = rng.normal(0, 0.5, (options.dimensions, 2)).astype(np.float32)
    bias = np.array([0.0, 0.0], np.float32)
    seen = np.full(BUCKETS, options.floor, np.float32)
    layer_seen, bias_seen = np.full_like(layer, 1e-3), np.full_like(bias, 1e-3)
    order = rng.permutation(len(bags))
    batches = []
    for at in range(0, len(order), options.batch):
        own = order[at:at + options.batch]
        used, place = np.unique(np.concatenate([bags[k][0] for k in own]), return_inverse=True)
        batches.append((own, used.astype(np.int32), place.astype(np.uint16)))
    pull = np.where(labels == 1, 1.0, options.clean_weight)[:, None]
    target = np.eye(2, dtype=np.float32)[labels]
    for _ in range(options.epochs):
        for b in rng.permutation(len(batches)):
            own, used, place = batches[b]
            place = place.astype(np.int64)
            row = np.repeat(np.arange(len(own)), [len(bags[k][0]) for k in own])
            weight = np.concatenate([damped(bags[k][1]) for k in own])
            inner, size = table[used], len(own)
            mean = np.stack([np.bincount(row, weight * inner[place, d], size) for d in range(options.dimensions)], 1)
            logits = options.gain * mean @ layer + bias
            chance = np.exp(logits - logits.max(1, keepdims=True))
            chance /= chance.sum(1, keepdims=True)
            off = (chance - target[own]) * pull[own] / size
            to_layer = options.gain * mean.T @ off
            back = options.gain * off @ layer.T
            to_table = np.stack([np.bincount(place, weight * back[row, d], len(used))
                                 for d in range(options.dimensions)], 1).astype(np.float32)
            seen[used] += (to_table ** 2).mean(1)
            table[used] -= options.rate * to_table / np.sqrt(seen[used])[:, None]
            layer_seen += to_layer ** 2
            layer -= (0.1 * options.rate * to_layer / np.sqrt(layer_seen)).astype(np.float32)
            bias_seen += off.sum(0) ** 2
            bias -= 0.1 * options.rate * off.sum(0) / np.sqrt(bias_seen)
    step = layer[:, 1] - layer[:, 0]
    return Model((options.gain * table @ step).astype(np.float32), float(bias[1] - bias[0]))


def held_out(id_col: str = "doc_id"):
    """Rows kept away from training: every fifth by crc32 of the id's text."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, options: Training = Training()) -> Model:
    """Train on labelled rows that are not held out.

    The sample is chosen on the narrow label table, so at most ``max_toxic +
    max_clean`` ids are broadcast; bags are made where the texts are read and
    hold at most ``BUCKETS`` numbers each.
    """
    usable = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(
        F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out()).groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"))
    mark = F.xxhash64("doc_id", F.lit(options.seed))
    chosen = usable.where("toxic = 1").orderBy(mark, "doc_id").limit(options.max_toxic).unionAll(
        usable.where("toxic = 0").orderBy(mark, "doc_id").limit(options.max_clean))

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches):
            found = [bag(t) for t in text_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([a.tobytes() for a, _ in found], pa.binary()),
                 pa.array([b.tobytes() for _, b in found], pa.binary())], ["doc_id", "toxic", "places", "counts"])

    texts = docs.select("doc_id", binary_text().alias("text"))
    rows = texts.join(F.broadcast(chosen), "doc_id").mapInArrow(
        bags, "doc_id long, toxic int, places binary, counts binary")
    model = _trained(rows.toArrow(), options)
    give_back()
    return model


def _trained(rows: pa.Table, options: Training) -> Model:
    rows = rows.sort_by([("doc_id", "ascending"), ("toxic", "ascending"), ("places", "ascending")])
    read = lambda name, kind: [np.frombuffer(x.as_buffer(), kind) for x in rows.column(name)]
    return train(list(zip(read("places", np.uint16), read("counts", np.uint32))),
                 rows.column("toxic").to_numpy().astype(np.int64), options)


def scores(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """Every row of ``docs`` with its score, the chance of label 1, as column ``name``; only the text is looked at.

    Null and empty texts get the score of the bias. The model is one float for
    each bucket, whatever the corpus. An existing column ``name`` is replaced.
    """
    given = docs.drop(name)
    text = given.schema.fieldNames().index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches):
            found = pa.array([model.score(t) for t in text_bytes(batch.column(text))], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, name])

    return given.mapInArrow(run, T.StructType([*given.schema.fields, T.StructField(name, T.DoubleType())]))
