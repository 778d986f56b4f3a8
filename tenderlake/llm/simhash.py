"""SimHash near-duplicates by deletion-variant signatures.

Fingerprints of at most ``d`` differing bits, cut into ``s`` segments with
``d < 2 s``, have a segment that differs by at most one bit. Every segment is
indexed under one key for each of its bits with that bit left out; two
segments that are equal or differ in one bit share such a key. Equal keys are
brought together by one shuffle, and each pair met there is verified on the
whole fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake.llm.common import binary_text, column, stored, text_batches, text_bytes, whole_groups
from tenderlake.llm.components import connected_components

SEED = 42
#: Groups of one key up to this size are compared in bulk, larger ones pivot by pivot.
BULK = 48


def shingle_hashes(text: bytes, width: int, bits: int) -> np.ndarray:
    """One row of ``bits / 64`` unsigned words for each shingle, repeats included."""
    words = text.lower().split()  # bytes: only A-Z and ASCII white space
    if not words:
        return np.empty((0, bits // 64), np.uint64)
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    starts = np.concatenate([[0], np.cumsum(sizes)])
    n = max(1, len(words) - width + 1)
    first, last = starts[:n].tolist(), (starts[min(width, len(words)):] - 1).tolist()
    if bits == 64:
        digest = xxhash.xxh64_intdigest
        return np.array([digest(joined[i:j], SEED) for i, j in zip(first, last)], np.uint64)[:, None]
    digest = xxhash.xxh3_128_digest
    return np.frombuffer(b"".join([digest(joined[i:j], SEED) for i, j in zip(first, last)]), ">u8") \
        .astype(np.uint64).reshape(-1, 2)


def fingerprint(hashes: np.ndarray) -> np.ndarray:
    """A bit is set if it is set in over half the rows."""
    if not len(hashes):
        return np.zeros(hashes.shape[1], np.uint64)
    octets = hashes.astype(">u8").view(np.uint8)
    ones = np.zeros(octets.shape[1] * 8, np.int64)
    for at in range(0, len(octets), 1 << 16):
        ones += np.unpackbits(octets[at:at + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(octets)).view(">u8").astype(np.uint64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                 bits: int = 64) -> DataFrame:
    """(id, fp0[, fp1]) for every row: words are split at ASCII white space, A-Z lower-cased.

    A text of fewer words than ``width`` is one shingle; null, empty and blank
    texts have the fingerprint zero.
    """
    names = [f"fp{k}" for k in range(bits // 64)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches):
            prints = np.array([fingerprint(shingle_hashes(t, width, bits)) for t in text_bytes(batch.column(1))])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(prints[:, k].astype(np.int64)) for k in range(len(names)))],
                ["id", *names])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), binary_text(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, " + ", ".join(f"{n} long" for n in names))


def segments_of(bits: int, max_distance: int, count: int | None = None) -> list[tuple[int, int]]:
    """(first bit, width) of the segments; by default the fewest of which one differs by at most one bit."""
    count = count or max_distance // 2 + 1
    edges = [bits * k // count for k in range(count + 1)]
    return [(edges[k], edges[k + 1] - edges[k]) for k in range(count)]


def _segment(prints: np.ndarray, at: int, width: int) -> np.ndarray:
    """Bits at .. at + width - 1 of fingerprints (rows of 64-bit words), counted from the lowest of word 0."""
    word, low = divmod(at, 64)
    value = prints[:, word] >> np.uint64(low)
    if low + width > 64:
        value = value | prints[:, word + 1] << np.uint64(64 - low)
    return value & np.uint64((1 << width) - 1)


def _variants(prints: np.ndarray, parts: list[tuple[int, int]]) -> np.ndarray:
    """For each fingerprint its keys: segment without one bit, that bit's number, segment number."""
    keys = []
    for k, (at, width) in enumerate(parts):
        value = _segment(prints, at, width)
        keys += [(value & ~np.uint64(1 << j)) << np.uint64(16) | np.uint64(k << 8 | j) for j in range(width)]
    return np.stack(keys, axis=1).astype(np.int64)


def _distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x ^ y).sum(axis=-1, dtype=np.int64)


def links(classes: DataFrame, bits: int, max_distance: int, segments: int | None = None) -> DataFrame:
    """Edges (a, b) that join all classes (rep, fp0[, fp1]) within ``max_distance`` bits as their pairs would.

    Every pair of ``2 * segments - 1`` bits or fewer has a key in common.
    Fewer, wider segments than that asks for make rarer keys, and leave out
    some of the pairs beyond it.

    Small key groups give every verified pair, once: under the first key that
    the pair shares. In a large one each fingerprint is compared with those
    not yet tied to it, so a dense group of near copies costs one pass, not
    all its pairs; what it gives spans the same components.
    """
    parts = segments_of(bits, max_distance, segments)
    names = [f"fp{k}" for k in range(bits // 64)]

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                prints = np.stack([column(part, n).astype(np.uint64) for n in names], axis=1)
                keys = _variants(prints, parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel()), *(pa.array(np.repeat(column(part, n), keys.shape[1]))
                                               for n in ["rep", *names])], ["key", "rep", *names])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole_groups(batches, "key"):
            prints = np.stack([column(part, n).astype(np.uint64) for n in names], axis=1)
            a, b = _group_links(column(part, "key"), column(part, "rep"), prints, parts, max_distance)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    longs = ", ".join(f"{n} long" for n in ["key", "rep", *names])
    keyed = classes.select("rep", *names).where(F.col("rep").isNotNull()).mapInArrow(index, longs)
    return keyed.repartition("key").sortWithinPartitions("key", "rep").mapInArrow(verify, "a long, b long").distinct()


def _group_links(key, rep, prints, parts, max_distance) -> tuple[np.ndarray, np.ndarray]:
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    sizes = np.diff(np.append(starts, len(key)))
    found_a, found_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    bulk = np.repeat((sizes > 1) & (sizes <= BULK), sizes)
    number = np.repeat(np.arange(len(starts)), sizes)[bulk]
    rep_s, prints_s, key_s = rep[bulk], prints[bulk], key[bulk]
    for step in range(1, BULK):
        i = np.flatnonzero(number[:-step] == number[step:]) if step < len(number) else number[:0]
        if not len(i):
            break
        i = i[_distance(prints_s[i], prints_s[i + step]) <= max_distance]
        i = i[_first_shared(prints_s[i], prints_s[i + step], key_s[i], parts)]
        found_a.append(rep_s[i])
        found_b.append(rep_s[i + step])
    for k in np.flatnonzero(sizes > BULK):
        own = slice(starts[k], starts[k] + sizes[k])
        for a, b in _span(rep[own], prints[own], max_distance):
            found_a.append(a)
            found_b.append(b)
    return np.concatenate(found_a), np.concatenate(found_b)


def _first_shared(x, y, key, parts) -> np.ndarray:
    """Whether ``key`` is the first that the pair shares."""
    segment, bit = key >> 8 & 0xFF, key & 0xFF
    good = np.ones(len(key), bool)
    for k, (at, width) in enumerate(parts):
        apart = np.bitwise_count(_segment(x, at, width) ^ _segment(y, at, width))
        good &= (segment <= k) | (apart > 1)
        good &= (segment != k) | (apart == 1) | (bit == 0)
    return good


def _span(rep, prints, max_distance) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Edges spanning the components of one large group."""
    label = np.arange(len(rep))
    for pivot in range(len(rep)):
        others = np.flatnonzero(label != label[pivot])
        if not len(others):
            return
        near = others[_distance(prints[others], prints[pivot]) <= max_distance]
        if len(near):
            # One edge for each component met is enough.
            met, first = np.unique(label[near], return_index=True)
            yield np.full(len(met), rep[pivot]), rep[near[first]]
            label[np.isin(label, met)] = label[pivot]


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, bits: int = 64,
                    max_distance: int = 3, segments: int | None = None) -> DataFrame:
    """(id, fp0[, fp1], component): component is the smallest id reachable by links of near fingerprints.

    Equal fingerprints are one class, so copies are compared once. Rows whose
    id is null link nothing; they take the component of their fingerprint if
    another row has it, else null. Repeated rows give repeated results.
    """
    names = [f"fp{k}" for k in range(bits // 64)]
    prints = stored(fingerprints(docs, id_col, text_col, width, bits), "prints")
    classes = stored(prints.groupBy(*names).agg(F.min("id").alias("rep")), "classes")
    found = connected_components(links(classes, bits, max_distance, segments))
    labelled = stored(classes.join(found, classes.rep == found.node, "left")
                      .select(*names, F.coalesce("component", "rep").alias("component")), "labelled")
    return prints.join(labelled, names).select("id", *names, "component")
