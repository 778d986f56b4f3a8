"""Embedding near-duplicates by product quantisation.

Unit vectors are put into coarse inverted lists; what remains to the list's
centre is stored as one code per subspace. A query probes every list whose
border is near, sums table look-ups for the distance to each coded vector,
drops those out of reach by more than their own coding error, and reranks the
rest by the exact cosine. Lists are searched in tiles of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake.llm.common import column, stored, whole_groups
from tenderlake.llm.components import connected_components


@dataclass(frozen=True)
class Settings:
    """sample: rows the index is fitted on, those of the smallest hashed ids; the index itself holds every row.

    margin: a list is probed if its border is nearer than this share of the
    search radius. A neighbour lies in a random direction of many dimensions,
    so it crosses a border at that depth hardly ever; 1.0 misses nothing.
    """

    sample: int = 20_000
    most_lists: int = 1024
    subspaces: int = 8
    codes: int = 64
    margin: float = 0.5
    rounds: int = 8
    seed: int = 11


@dataclass(frozen=True)
class Quantiser:
    centres: np.ndarray
    books: np.ndarray  # subspace, code, dimension

    def split(self, x: np.ndarray) -> np.ndarray:
        """Rows cut into subspaces, zero-padded to equal widths."""
        m, _, width = self.books.shape
        out = np.zeros((len(x), m * width), np.float32)
        out[:, :x.shape[1]] = x
        return out.reshape(len(x), m, width)

    def encode(self, residuals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes and the distance of each row to what its codes stand for."""
        parts = self.split(residuals)
        codes = np.empty(parts.shape[:2], np.uint8)
        off = np.zeros(len(parts))
        for m, book in enumerate(self.books):
            d = _squared(parts[:, m], book)
            codes[:, m] = d.argmin(1)
            off += np.maximum(d.min(1), 0)
        return codes, np.sqrt(off)


def _squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * x @ y.T + (y * y).sum(1)[None]


def _kmeans(x: np.ndarray, k: int, rounds: int, rng) -> np.ndarray:
    k = min(k, len(x))
    centres = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        own = np.concatenate([_squared(x[i:i + 4096], centres).argmin(1) for i in range(0, len(x), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        n = np.bincount(own, minlength=k)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def fit(sample: np.ndarray, lists: int, options: Settings) -> Quantiser:
    """Coarse centres and residual codebooks from a sample of unit vectors."""
    rng = np.random.default_rng(options.seed)
    sample = sample.astype(np.float32)
    centres = _kmeans(sample, lists, options.rounds, rng)
    residuals = sample - centres[_squared(sample, centres).argmin(1)]
    m = min(options.subspaces, sample.shape[1])
    width = -(-sample.shape[1] // m)
    shape = Quantiser(centres, np.zeros((m, 1, width), np.float32))
    parts = shape.split(residuals)
    size = min(options.codes, len(sample))
    return Quantiser(centres, np.stack([_kmeans(parts[:, k], size, options.rounds, rng) for k in range(m)]))


def _matrix(part, name: str = "vector") -> np.ndarray:
    found = part.column(name)
    found = found.combine_chunks() if isinstance(found, pa.ChunkedArray) else found
    return found.flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1).astype(np.float64)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # so that no square overflows or vanishes
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", threshold: float = 0.93, options: Settings = Settings()) -> DataFrame:
    """(id, n_links, component, kept) for every row.

    Rows of equal, non-null label link at a cosine of ``threshold`` or more.
    n_links counts the other rows linked directly, component is the smallest
    id reachable (the own id included), kept marks the row that stands for its
    component. Null vectors, zero vectors, vectors with null or non-finite
    components, and rows of null id or label link with nothing; vectors of
    different lengths do not link with each other, and every length has an
    index of its own. Equal vectors are indexed once and counted as often as
    they occur; repeated rows count as rows of their own.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
                          F.col(vector_col).alias("vector"))
    sound = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("vector") > 0) & F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(
        "vector", lambda x: x != 0))
    classes = stored(sound.groupBy("label", "vector").agg(F.min("id").alias("rep"), F.count("*").alias("copies")),
                     "vectors")
    found = classes.sparkSession.createDataFrame([], "edge boolean, a long, b long, n long")
    for length in classes.groupBy(F.size("vector").alias("n")).count().where("count > 1").orderBy("n").collect():
        own = classes.where(F.size("vector") == length["n"])
        found = found.unionAll(stored(_links(own, length["count"], threshold, options), "vector-links"))
    counts = found.where("not edge").groupBy(F.col("a").alias("rep")).agg((F.sum("n") - 1).alias("n_links"))
    groups = connected_components(found.where("edge"))
    done = stored(classes.join(counts, "rep", "left").join(groups, F.col("rep") == F.col("node"), "left").select(
        "label", "vector", F.greatest(F.coalesce("n_links", F.col("copies") - 1), F.lit(0)).alias("n_links"),
        F.coalesce("component", "rep").alias("component")), "vector-classes")
    # Rows that take no part must not meet a class: their id is null.
    out = rows.join(done, (rows.label == done.label) & (rows.vector == done.vector) & rows.id.isNotNull(), "left")
    component = F.coalesce("component", "id")
    return out.select("id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component"),
                      F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))


def _links(classes: DataFrame, n: int, threshold: float, options: Settings) -> DataFrame:
    """Rows (edge, a, b, n): for edge, a and b are linked or in one component; else a is linked to n rows by one tile."""
    sample = classes.orderBy(F.xxhash64("rep", F.lit(options.seed)), "rep").limit(options.sample).select("vector")
    sample = _unit(_matrix(sample.toArrow()))
    model = fit(sample, int(np.clip(np.sqrt(n) / 4, 1, options.most_lists)), options)
    radius = float(np.sqrt(2 - 2 * threshold))
    tile = int(np.clip(n / 64, 64, 4096))
    gaps = np.sqrt(np.maximum(_squared(model.centres, model.centres), 1e-12))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                x = _unit(_matrix(part)).astype(np.float32)
                d = _squared(x, model.centres)
                own = d.argmin(1)
                codes, off = model.encode(x - model.centres[own])
                border = (d - d[np.arange(len(x)), own][:, None]) / (2 * gaps[own])
                near = border <= options.margin * radius
                near[np.arange(len(x)), own] = True
                yield pa.RecordBatch.from_pydict({
                    "label": part.column("label"), "rep": part.column("rep"), "copies": part.column("copies"),
                    "vector": part.column("vector"), "list": pa.array(own.astype(np.int32)),
                    "probes": pa.array([np.flatnonzero(r).astype(np.int32) for r in near], pa.list_(pa.int32())),
                    "code": pa.array([c.tobytes() for c in codes], pa.binary()), "off": pa.array(off)})

    kind = classes.schema["vector"].dataType.simpleString()
    placed = stored(classes.select("label", "rep", "copies", "vector").mapInArrow(
        place, f"label string, rep long, copies long, vector {kind}, list int, probes array<int>, code binary, "
               "off double"), "placed")
    probes = placed.select("label", "rep", "copies", "vector", F.col("list").alias("home"), F.explode("probes").alias("list"))
    # Rows of a list and queries of a list are cut into slices; each pair of slices is a tile.
    slices = lambda c: F.ceil(F.col(c) / tile).cast("int")
    cells = stored(placed.groupBy("label", "list").agg(F.count("*").alias("held")).join(
        probes.groupBy("label", "list").agg(F.count("*").alias("asked")), ["label", "list"]).select(
        "label", "list", slices("held").alias("held"), slices("asked").alias("asked")), "cells")
    spread = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    part_of = lambda c: F.pmod(F.xxhash64("rep"), F.col(c)).cast("int")
    held = placed.join(cells, ["label", "list"]).select(
        "label", "list", part_of("held").alias("i"), spread("asked").alias("j"), F.lit(0).alias("role"), "rep",
        "copies", "vector", "code", "off", F.col("list").alias("home"), "probes")
    asked = probes.join(cells, ["label", "list"]).select(
        "label", "list", spread("held").alias("i"), part_of("asked").alias("j"), F.lit(1).alias("role"), "rep",
        "copies", "vector", F.lit(b"").alias("code"), F.lit(0.0).alias("off"), "home", F.array().cast("array<int>").alias("probes"))
    tiles = held.unionByName(asked).withColumn("key", F.xxhash64("label", "list", "i", "j"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole_groups(batches, "key", 20_000):
            edge, a, b, total = [], [], [], []
            keys = column(part, "key")
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            for begin, end in zip(starts, np.append(starts[1:], len(keys))):
                for e, x, y, n_rows in _tile(part.slice(begin, end - begin), model, radius, threshold):
                    edge.append(np.full(len(x), e))
                    a.append(x)
                    b.append(y)
                    total.append(n_rows)
            if a:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(edge), pa.bool_()), *(pa.array(np.concatenate(c), pa.int64())
                                                                   for c in (a, b, total))], ["edge", "a", "b", "n"])

    return tiles.repartition("key").sortWithinPartitions("key", "role", "rep").mapInArrow(
        search, "edge boolean, a long, b long, n long")


#: Queries of a tile compared at once.
QUERIES = 256


def _tile(part: pa.Table, model: Quantiser, radius: float, threshold: float):
    """Link counts of a tile's rows and edges that span their components; memory follows ``QUERIES`` times the rows held.

    A pair of two lists is found by every query that probes the other's list;
    where only one does, its link counts for both ends.
    """
    role = column(part, "role")
    cut = int(np.searchsorted(role, 1))
    if cut in (0, len(role)):
        return
    rep, label, lists = column(part, "rep"), np.array(part.column("label").to_pylist()), column(part, "list")
    copies, home, off = column(part, "copies"), column(part, "home"), column(part, "off")[:cut]
    x = _unit(_matrix(part))
    known, asked = x[:cut], x[cut:]
    codes = np.frombuffer(b"".join(part.column("code").slice(0, cut).to_pylist()), np.uint8).reshape(cut, -1)
    probed = np.zeros((cut, len(model.centres)), bool)
    for k, own in enumerate(part.column("probes").slice(0, cut).to_pylist()):
        probed[k, own] = True
    names, place = np.unique(rep, return_inverse=True)
    root = np.arange(len(names))
    linked, back = np.zeros(len(asked), np.int64), np.zeros(cut, np.int64)
    for at in range(0, len(asked), QUERIES):
        own = np.arange(at, min(at + QUERIES, len(asked)))
        # Asymmetric distances: one table of squared distances for each query and subspace.
        queries = model.split((asked[own] - model.centres[lists[cut + own]]).astype(np.float32))
        reach = np.zeros((len(own), cut), np.float32)
        for m, book in enumerate(model.books):
            reach += _squared(queries[:, m], book)[:, codes[:, m]]
        reach = np.sqrt(np.maximum(reach, 0)) <= radius + off + 1e-3
        reach &= (label[cut + own, None] == label[:cut]) & (lists[cut + own, None] == lists[:cut])
        cosine = asked[own] @ known.T
        # At the very threshold, sums in one fixed order decide, for both ends alike.
        q, k = np.nonzero(reach & (np.abs(cosine - threshold) < 1e-9))
        cosine[q, k] = np.einsum("ij,ij->i", asked[own[q]], known[k])
        q, k = np.nonzero(reach & (cosine >= threshold))
        linked[own] = np.bincount(q, copies[k], len(own)).astype(np.int64)
        alone = ~probed[k, home[cut + own[q]]]
        back += np.bincount(k[alone], copies[cut + own[q[alone]]], cut).astype(np.int64)
        _tie(root, place[cut + own[q]], place[k])
    for ids, n in ((rep[cut:], linked), (rep[:cut], back)):
        some = np.flatnonzero(n)
        yield False, ids[some], ids[some], n[some]
    tied = np.flatnonzero(root != np.arange(len(names)))
    yield True, names[tied], names[root[tied]], np.zeros(len(tied), np.int64)


def _tie(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give the smallest root to all that the pairs (a, b) join."""
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return
        x, y = x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(root, root[root]):
            root[:] = root[root]
