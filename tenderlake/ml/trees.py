"""Spark ML's boosted trees and forests for dense numbers, learned from binned rows in numpy.

The rows are binned once (bins of several features share a 16-bit code) and
written below the shared folder as slices of plain arrays. Every level of a
tree is one pass: tasks read their slices, send the rows to their nodes and
count rows and labels by node and bin. Boosting sums these counts on the
driver, one small table for each task; a forest sums them by tree and nodes in a
shuffle, some trees at a time. Between passes a task leaves the nodes (and
what is left of the labels) in files of its own name, so a repeated task
disturbs nothing. The result is a model of Spark ML with all its statistics.

Cells are as in Spark: the same thresholds, splits, gains and leaves, and the
bootstrap counts of a row depend on its slice and the seed. What is not
learned here (categories, weights, validation, other losses, wide vectors or
deep trees) is left to Spark's own trainer.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterator
from contextlib import ExitStack
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (GBTRegressionModel, GBTRegressor, RandomForestRegressionModel,
                                   RandomForestRegressor)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.session import delete, scratch_folder, scratch_tables

#: Cells that the bins of features sharing a code may have.
CELLS = 2048
#: Cells of such tables for each row at most.
CODED = 1.5
#: Rows of a slice and of what a forest holds at once in a task.
SLICE, BLOCK = 1 << 17, 1 << 21
#: Trees of a forest learned together, and their nodes summed together.
TOGETHER, NODES = 10, 64
#: Beyond these Spark's trainer is used.
MOST_FEATURES, MOST_BINS, MOST_DEPTH = 256, 1024, 12
#: Gains below this share of the mean square are noise of the sums.
NOISE = 1e-13
SLICES = "path string, offset long, rows long"
NODE_DATA = pa.struct([
    ("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())),
    ("rawCount", pa.int64()), ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()),
    ("split", pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())),
                         ("numCategories", pa.int32())]))])


# --- bins -------------------------------------------------------------------

def thresholds(values: np.ndarray, most: int) -> np.ndarray:
    """Thresholds between the sampled values of a feature: all of them, or ``most`` at even steps, as Spark finds them."""
    seen, counts = np.unique(values, return_counts=True)
    middles = (seen[:-1] + seen[1:]) / 2.0
    if len(middles) <= most:
        return middles
    stride = target = len(values) / (most + 1)
    chosen, before = [], int(counts[0])
    for i, count in enumerate(counts[1:].tolist()):
        after = before + count
        if abs(before - target) < abs(after - target):
            chosen.append(i)
            target += stride
        before = after
    return middles[chosen]


@dataclass
class Bins:
    """Thresholds of each feature, and the features that share a code: its digits are their bins."""

    cuts: list[np.ndarray]
    groups: list[list[int]] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.sizes = [len(c) + 1 for c in self.cuts]
        self.begins = np.cumsum([0, *self.sizes])
        for feature in sorted(range(len(self.sizes)), key=lambda f: -self.sizes[f]):
            for group in self.groups:
                if math.prod(self.sizes[f] for f in group) * self.sizes[feature] <= CELLS:
                    group.append(feature)
                    break
            else:
                self.groups.append([feature])
        # Features with few bins come first: the sums over tables run along the long ones.
        self.groups = [group[::-1] for group in self.groups]
        self.cells = [math.prod(self.sizes[f] for f in group) for group in self.groups]

    def codes(self, values: np.ndarray) -> np.ndarray:
        """Codes of rows, one line a group."""
        out = np.zeros((len(self.groups), len(values)), np.uint16)
        for code, group in zip(out, self.groups, strict=True):
            for f in group:
                code *= self.sizes[f]
                # A value goes left of a threshold that it equals.
                code += np.searchsorted(self.cuts[f], values[:, f], side="left").astype(np.uint16)
        return out

    def routes(self, feature: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each node its group and a table by code: whether the row goes right; rows of a leaf go left."""
        group, right = np.zeros(len(feature), np.intp), np.zeros((len(feature), max(self.cells)), np.bool_)
        for k, f, digit in self.digits():
            for node in np.flatnonzero(feature == f):
                group[node] = k
                right[node, :self.cells[k]] = digit > cut[node]
        return group, right

    def digits(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """(group, feature, bin of the feature by code of the group)."""
        for k, group in enumerate(self.groups):
            for f, digit in zip(group, np.unravel_index(np.arange(self.cells[k]), [self.sizes[f] for f in group]), strict=True):
                yield k, f, digit

    def counter(self, nodes: int, rows: int) -> Counter:
        """Counts by code where tables of all codes and nodes are small against the rows, by single bins otherwise."""
        return Counter(self, nodes, nodes * sum(self.cells) <= CODED * rows)


class Counter:
    """Rows and labels by node and bin of each feature."""

    def __init__(self, bins: Bins, nodes: int, coded: bool):
        self.bins, self.nodes, self.coded = bins, nodes, coded
        self.squares = np.zeros(nodes)
        if coded:
            self.tables = [np.zeros((2, nodes * c)) for c in bins.cells]
        else:
            self.tables = [np.zeros((2, nodes * s)) for s in bins.sizes]
            self.digits = [(k, f, digit.astype(np.intp)) for k, f, digit in bins.digits()]

    def add(self, codes: np.ndarray, node: np.ndarray | None, label: np.ndarray, weight: np.ndarray | None = None) -> None:
        """Add rows, a slice at a time where the tables are smaller than that."""
        rows = len(label)
        step = SLICE if max(t.shape[1] for t in self.tables) <= SLICE // 2 else max(rows, 1)
        for i in range(0, rows, step):
            part = slice(i, i + step)
            self._add(codes[:, part], None if node is None else node[part], label[part], None if weight is None else weight[part])

    def _add(self, codes: np.ndarray, node: np.ndarray | None, label: np.ndarray, weight: np.ndarray | None) -> None:
        weighted = label if weight is None else label * weight
        self.squares += np.dot(weighted, label) if node is None else np.bincount(node, weighted * label, self.nodes)
        if self.coded:
            for k, (table, width) in enumerate(zip(self.tables, self.bins.cells, strict=True)):
                if node is None:
                    cell = codes[k].astype(np.intp)
                else:
                    cell = node * width
                    cell += codes[k]
                self._put(table, cell, weighted, weight)
            return
        for k, f, digit in self.digits:
            cell = digit.take(codes[k])
            if node is not None:
                cell += node * self.bins.sizes[f]
            self._put(self.tables[f], cell, weighted, weight)

    def _put(self, table: np.ndarray, cell: np.ndarray, weighted: np.ndarray, weight: np.ndarray | None) -> None:
        table[0] += np.bincount(cell, weight, table.shape[1])
        table[1] += np.bincount(cell, weighted, table.shape[1])

    def result(self) -> np.ndarray:
        """Rows and labels by node and bin; the last column has the sums of squares."""
        bins, nodes = self.bins, self.nodes
        out = np.zeros((nodes, bins.begins[-1] + 1, 2))
        out[:, -1, 0] = self.squares

        def put(f: int, sums: np.ndarray) -> None:
            out[:, bins.begins[f]:bins.begins[f + 1]] = np.moveaxis(sums, 0, -1)

        if not self.coded:
            for f, table in enumerate(self.tables):
                put(f, table.reshape(2, nodes, -1))
            return out
        for group, table in zip(bins.groups, self.tables, strict=True):
            for f in group:
                table = table.reshape(2, nodes, bins.sizes[f], -1)
                put(f, table.sum(3))
                table = table.sum(2)
        return out


@dataclass
class Level:
    """Nodes of one level of a tree: rows, sum and sum of squares; the split, if any, with its gain and left side."""

    stats: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    gain: np.ndarray
    left: np.ndarray

    def values(self) -> np.ndarray:
        """Means of the children; both of a leaf have its own."""
        here, split = self.stats[:, :2], (self.feature >= 0)[:, None]
        sides = np.stack([np.where(split, self.left, here), np.where(split, here - self.left, here)], 1).reshape(-1, 2)
        return _ratio(sides[:, 1], sides[:, 0])


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.divide(a, b, out=np.zeros(len(a)), where=b > 0)


def best_splits(counts: np.ndarray, bins: Bins, least_rows: int, least_gain: float) -> Level:
    """The split with the greatest fall in variance for each node of ``marginals``."""
    nodes = len(counts)
    first = counts[:, bins.begins[0]:bins.begins[1]].sum(1)
    stats = np.column_stack([first, counts[:, -1, 0]])
    rows, total = stats[:, 0], stats[:, 1]
    top = np.full(nodes, -np.inf)
    feature, cut, left = np.full(nodes, -1), np.zeros(nodes, np.int64), np.zeros((nodes, 2))
    each = np.arange(nodes)
    for f, size in enumerate(bins.sizes):
        if size < 2:
            continue
        sides = counts[:, bins.begins[f]:bins.begins[f] + size - 1].cumsum(1)
        n, s = sides[..., 0], sides[..., 1]
        m, t = rows[:, None] - n, total[:, None] - s
        fits = (n >= max(least_rows, 1)) & (m >= max(least_rows, 1))
        score = np.where(fits, s * s / np.where(fits, n, 1) + t * t / np.where(fits, m, 1), -np.inf)
        at = score.argmax(1)
        better = score[each, at] > top
        top = np.where(better, score[each, at], top)
        feature, cut = np.where(better, f, feature), np.where(better, at, cut)
        left = np.where(better[:, None], sides[each, at], left)
    with np.errstate(invalid="ignore"):
        gain = _ratio(top - total * _ratio(total, rows), rows)
    leaf = ~np.isfinite(gain) | (gain <= NOISE * _ratio(stats[:, 2], rows)) | (gain < least_gain)
    return Level(stats, np.where(leaf, -1, feature), cut, np.where(leaf, -1.0, gain), left)


# --- rows in files ------------------------------------------------------------

class Files:
    """Reads arrays of files below the shared folder; handles stay open as long as the object."""

    def __init__(self, folder: str):
        self.store, self.top = pyarrow.fs.FileSystem.from_uri(folder)
        self.open, self.stack = {}, ExitStack()

    def __enter__(self) -> Files:
        return self

    def __exit__(self, *how) -> None:
        self.stack.close()

    def read(self, name: str, offset: int, count: int, kind) -> np.ndarray:
        if name not in self.open:
            self.open[name] = self.stack.enter_context(self.store.open_input_file(f"{self.top}/{name}"))
        size = count * np.dtype(kind).itemsize
        return np.frombuffer(self.open[name].read_at(size, offset), kind, count)

    def new(self) -> tuple[str, pa.NativeFile]:
        name = uuid.uuid4().hex
        return name, self.stack.enter_context(self.store.open_output_stream(f"{self.top}/{name}"))


@dataclass
class Rows:
    """Binned rows in slices: codes of each group, then the labels. Each task has slices of its own."""

    folder: str
    bins: Bins
    tasks: list[list[tuple[str, int, int]]]

    def slices(self, files: Files, of: list[tuple[str, int, int]], at_once: int = 0, left: str | None = None):
        """Codes and labels of a task's slices, those of ``at_once`` rows together; ``left`` is a file with other labels."""
        held, height, begin = [], 0, 0
        for i, (name, offset, rows) in enumerate(of):
            groups = len(self.bins.groups)
            codes = files.read(name, offset, groups * rows, np.uint16).reshape(groups, rows)
            held.append((codes, files.read(name, offset + 2 * groups * rows, rows, np.float64) if left is None
                         else files.read(left, 8 * begin, rows, np.float64)))
            height, begin = height + rows, begin + rows
            if i + 1 == len(of) or height + of[i + 1][2] > at_once:
                yield held[0] if len(held) == 1 else (np.concatenate([c for c, _ in held], 1),
                                                      np.concatenate([y for _, y in held]))
                held, height = [], 0


def binned(dataset: DataFrame, features: str, label: str, most_bins: int, seed: int) -> Rows | None:
    """Bin the rows by thresholds of a sample (Spark's size) and store them; None if the vectors are too wide."""
    spark = dataset.sparkSession
    context, folder = spark.sparkContext, scratch_folder(spark, "binned")
    values = dataset.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"))
    rows = dataset.select(label).count()
    if rows == 0:
        raise ValueError("no rows to learn from")
    first = values.select("x").first().x
    if len(first) > MOST_FEATURES:
        return None
    most_bins = min(most_bins, rows)
    wanted = max(most_bins * most_bins, 10_000)
    sample = values.select("x") if wanted >= rows else values.select("x").sample(False, wanted / rows, seed)
    seen = [r.x for r in sample.collect()] or [first]
    bins = Bins([thresholds(column, most_bins - 1) for column in np.array(seen).T])
    size = min(SLICE, max(1 << 12, -(-rows // (4 * context.defaultParallelism))))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with Files(folder) as files:
            files.store.create_dir(files.top, recursive=True)
            name, out, found, codes, labels, held = None, None, [], [], [], 0

            def put(whole: np.ndarray, y: np.ndarray) -> None:
                found.append((name, out.tell(), len(y)))
                out.write(np.ascontiguousarray(whole).tobytes())
                out.write(y.tobytes())

            for batch in batches:
                if batch.num_rows == 0:
                    continue
                if out is None:
                    name, out = files.new()
                y = batch.column(1).to_numpy(zero_copy_only=False).astype(np.float64)
                if np.isnan(y).any():
                    raise ValueError(f"labels must be numbers, not NULL or NaN: {label}")
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                codes.append(bins.codes(x))
                labels.append(y)
                held += batch.num_rows
                if held >= size:
                    whole, y = np.concatenate(codes, 1), np.concatenate(labels)
                    for i in range(0, held - size + 1, size):
                        put(whole[:, i:i + size], y[i:i + size])
                    held %= size
                    codes, labels = [whole[:, len(y) - held:]], [y[len(y) - held:]]
            if held:
                put(np.concatenate(codes, 1), np.concatenate(labels))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found, strict=True)], ["path", "offset", "rows"])

    found = sorted(tuple(r) for r in values.mapInArrow(write, SLICES).collect())
    # A task takes slices of about as many rows as any other; large inputs have some more tasks than cores.
    cores = context.defaultParallelism
    dealt = min(len(found), cores * (1 if rows <= cores * BLOCK else 3))
    before = np.cumsum([0, *[r for *_, r in found]])[:-1]
    task = before * dealt // rows
    return Rows(folder, bins, [[found[i] for i in np.flatnonzero(task == t)] for t in np.unique(task)])


def _routed(codes: np.ndarray, node: np.ndarray | None, routes: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The children that rows go to."""
    group, right = routes
    if node is None:
        return right[0].take(codes[group[0]]).astype(np.intp)
    if (group == group[0]).all():
        code = codes[group[0]]
    else:
        # The code of a row's node lies in the line of its group.
        place = (group * codes.shape[1]).take(node)
        place += np.arange(codes.shape[1])
        code = codes.ravel().take(place)
    child = node * right.shape[1]
    child += code
    child = right.ravel().take(child).astype(np.intp)
    child += node
    child += node
    return child


def _over(rows: Rows, spark: SparkSession, work, *more: list):
    """``work`` over the tasks' slices, each with its items of other lists, as an RDD."""
    context = spark.sparkContext
    items = list(zip(range(len(rows.tasks)), rows.tasks, *more, strict=True))
    return context.parallelize(items, len(items)).flatMap(lambda item: work(*item))


# --- boosting -----------------------------------------------------------------

def boost(rows: Rows, spark: SparkSession, trees: int, depth: int, step: float, least_rows: int, least_gain: float):
    """Trees of least squares on twice what the trees before have left, as (levels, leaves' stats, leaves' values)."""
    bins, folder, kind = rows.bins, rows.folder, np.uint8 if depth <= 8 else np.uint16
    left = at = [None] * len(rows.tasks)
    learned, levels = [], []

    def pass_over(done: list[Level], level: int, values, factor: float, fresh: bool):
        """One pass: rows go on by the last level's split. At the root the tree before is taken off the labels."""
        turn = (done[-1].feature, done[-1].cut) if done else None
        nodes, first, final = 1 << level, level == 0, level == depth

        def work(_, slices, rest, place):
            routes = bins.routes(*turn) if turn else None
            counter, leaves = bins.counter(nodes, sum(r for *_, r in slices)), np.zeros((3, 1 << depth))
            with Files(folder) as files:
                out = None if final or (first and values is None) else files.new()
                height = 0
                for codes, label in rows.slices(files, slices, left=rest):
                    n, node = len(label), None
                    if routes is not None:
                        if place is not None:
                            node = files.read(place, height * np.dtype(kind).itemsize, n, kind).astype(np.intp)
                        node = _routed(codes, node, routes)
                    height += n
                    if values is not None:
                        for line, w in zip(leaves, (None, label, label * label), strict=True):
                            line += np.bincount(node, w, 1 << depth)
                        if final:
                            continue
                        label = (2.0 * (label - values.take(node))) if fresh else label - factor * values.take(node)
                        node = None
                        out[1].write(label.tobytes())
                    elif not first:
                        out[1].write(node.astype(kind).tobytes())
                    counter.add(codes, node, label)
            yield out and out[0], None if final else counter.result(), leaves

        found = _over(rows, spark, work, left, at).collect()
        total = None if final else reduce(np.add, [c for _, c, _ in found])
        return [name for name, *_ in found], total, reduce(np.add, [x for *_, x in found]).T

    def forget(names: list) -> None:
        for name in names:
            if name is not None:
                delete(spark, f"{folder}/{name}")

    for tree in range(trees + 1):
        values = levels[-1].values() if levels else None
        final = tree == trees
        names, counts, leaves = pass_over(levels[-1:], depth if final else 0, values, 2.0 * step, tree == 1)
        forget(at)
        if levels:
            learned.append((levels, leaves, values))
        if final:
            forget(left)
            return learned
        if values is not None:
            forget(left)
            left = names
        at = [None] * len(rows.tasks)
        levels = [best_splits(counts, bins, least_rows, least_gain)]
        for level in range(1, depth):
            names, counts, _ = pass_over(levels[-1:], level, None, 0.0, False)
            forget(at)
            at = names
            levels.append(best_splits(counts, bins, least_rows, least_gain))


# --- forest -------------------------------------------------------------------

def poisson_counts(rate: float) -> np.ndarray:
    """Bootstrap counts by a 16-bit draw."""
    chances = [math.exp(-rate)]
    while len(chances) < 256 and sum(chances) < 1 - 1e-9:
        chances.append(chances[-1] * rate / len(chances))
    edges = np.round(np.cumsum(chances) * 65536)
    return np.searchsorted(edges, np.arange(65536), side="right").astype(np.uint8)


def forest(rows: Rows, spark: SparkSession, trees: int, depth: int, rate: float | None, seed: int, least_rows: int,
           least_gain: float):
    """Independent trees over bootstrapped rows (all rows, if there is no rate), as (levels, leaves' stats, leaves' values)."""
    bins, folder = rows.bins, rows.folder
    drawn = None if rate is None else poisson_counts(rate)
    cores = spark.sparkContext.defaultParallelism

    def samples(task: int, of: range, slices, place, routes, files: Files):
        """(tree, codes, node, labels, weights) for each block of rows and each tree."""
        height = 0
        for block, (codes, label) in enumerate(rows.slices(files, slices, BLOCK)):
            for i, tree in enumerate(of):
                if drawn is None:
                    mine, y, weight = codes, label, np.ones(len(label))
                else:
                    draw = np.random.default_rng([seed % (1 << 63), tree, task, block])
                    counts = drawn.take(draw.integers(0, 65536, len(label), np.uint16))
                    chosen = np.flatnonzero(counts)
                    mine, weight = codes.take(chosen, 1), counts.take(chosen).astype(np.float64)
                    y = label.take(chosen)
                node = None
                if routes is not None:
                    if place is not None:
                        node = files.read(place, 2 * height, len(y), np.uint16).astype(np.intp)
                    node = _routed(mine, node, routes[i])
                height += len(y)
                yield i, mine, node, y, weight

    def grow(of: range, done: list[list[Level]], level: int, at: list):
        nodes = 1 << level
        turns = [(t[-1].feature, t[-1].cut) for t in done] if level else None
        chunks = -(-nodes // NODES)

        def work(task, slices, place):
            routes = turns and [bins.routes(*t) for t in turns]
            sums = np.zeros((len(of), nodes, bins.begins[-1] + 1, 2))
            with Files(folder) as files:
                out = files.new() if level else None
                for i, codes, node, y, weight in samples(task, of, slices, place, routes, files):
                    if out:
                        out[1].write(node.astype(np.uint16).tobytes())
                    counter = bins.counter(nodes, len(y))
                    counter.add(codes, node, y, weight)
                    sums[i] += counter.result()
            yield -1, (task, out and out[0])
            for i, counts in enumerate(sums):
                for c in range(chunks):
                    part = counts[c * NODES:(c + 1) * NODES]
                    if part[:, :, 0].any():
                        yield i * chunks + c, (task, part)

        def total(pairs):
            parts: dict[int, list] = {}
            for key, part in pairs:
                if key < 0:
                    yield key, part
                else:
                    parts.setdefault(key, []).append(part)
            for key, found in parts.items():
                # In order of the tasks: sums do not depend on which comes first.
                counts = reduce(np.add, [p for _, p in sorted(found, key=lambda x: x[0])])
                yield key, best_splits(counts, bins, least_rows, least_gain)

        keys = len(of) * chunks
        found = _over(rows, spark, work, at).partitionBy(min(keys, 4 * cores), lambda key: max(key, 0)) \
            .mapPartitions(total).collect()
        names = [name for _, name in sorted(part for key, part in found if key < 0)]
        splits = {key: part for key, part in found if key >= 0}
        for i, tree in enumerate(done):
            tree.append(_joined([splits.get(i * chunks + c) for c in range(chunks)], min(nodes, NODES)))
        return names

    def leaves(of: range, done: list[list[Level]], at: list) -> np.ndarray:
        turns = [(t[-1].feature, t[-1].cut) for t in done]

        def work(task, slices, place):
            routes = [bins.routes(*t) for t in turns]
            sums = np.zeros((len(of), 1 << depth, 3))
            with Files(folder) as files:
                for i, _, node, y, weight in samples(task, of, slices, place, routes, files):
                    for j, w in enumerate((weight, weight * y, weight * y * y)):
                        sums[i, :, j] += np.bincount(node, w, 1 << depth)
            yield sums

        return reduce(np.add, _over(rows, spark, work, at).collect())

    learned = []
    for begin in range(0, trees, TOGETHER):
        of = range(begin, min(trees, begin + TOGETHER))
        done, at = [[] for _ in of], [None] * len(rows.tasks)
        for level in range(depth):
            names = grow(of, done, level, at)
            for name in at:
                if name is not None:
                    delete(spark, f"{folder}/{name}")
            at = names
        for levels, stats in zip(done, leaves(of, done, at), strict=True):
            learned.append((levels, stats, _ratio(stats[:, 1], stats[:, 0])))
        for name in at:
            if name is not None:
                delete(spark, f"{folder}/{name}")
    return learned


def _joined(parts: list[Level | None], nodes: int) -> Level:
    """Levels of neighbouring nodes as one; where nothing was counted there are no rows."""
    none = Level(np.zeros((nodes, 3)), np.full(nodes, -1), np.zeros(nodes, np.int64), np.full(nodes, -1.0), np.zeros((nodes, 2)))
    parts = [none if p is None else p for p in parts]
    return Level(*(np.concatenate([getattr(p, c) for p in parts]) for c in ("stats", "feature", "cut", "gain", "left")))


# --- models -------------------------------------------------------------------

def node_rows(tree, bins: Bins) -> list[dict]:
    """Nodes in the order of Spark's files; two leaves of one parent that predict the same are one."""
    levels, leaves, values = tree
    out: list[dict] = []

    def add(level: int, i: int) -> dict:
        at, split = len(out), level < len(levels) and levels[level].feature[i] >= 0
        stats = levels[level].stats[i] if level < len(levels) else leaves[i]
        rows, total, squares = (float(v) for v in stats)
        mean = total / rows if rows else 0.0
        # A leaf predicts what its rows had as the next tree was learned.
        value = mean if split else float(values[i << (len(levels) - level)])
        node = {"id": at, "prediction": value, "impurity": max(squares / rows - mean * mean, 0.0) if rows else 0.0,
                "impurityStats": [rows, total, squares], "rawCount": round(rows), "gain": -1.0, "leftChild": -1,
                "rightChild": -1, "split": {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1}}
        out.append(node)
        if split:
            a, b = add(level + 1, 2 * i), add(level + 1, 2 * i + 1)
            if a["leftChild"] < 0 and b["leftChild"] < 0 and a["prediction"] == b["prediction"]:
                del out[at + 1:]
                node["prediction"] = a["prediction"]
            else:
                f, cut = int(levels[level].feature[i]), int(levels[level].cut[i])
                node |= {"gain": float(levels[level].gain[i]), "leftChild": a["id"], "rightChild": b["id"],
                         "split": {"featureIndex": f, "leftCategoriesOrThreshold": [float(bins.cuts[f][cut])],
                                   "numCategories": -1}}
        return node

    add(0, 0)
    return out


def as_model(kind, learned: list, weights: list[float], bins: Bins, spark: SparkSession, uid: str, depth: int):
    """The trees as a model of Spark ML: written in the layout of its models, and loaded."""
    path = scratch_folder(spark, "trees")
    tree_kind = "org.apache.spark.ml.regression.DecisionTreeRegressionModel"
    about = {"timestamp": 0, "sparkVersion": spark.version, "paramMap": {"maxDepth": depth}, "defaultParamMap": {"impurity": "variance"},
             "numFeatures": len(bins.sizes)}
    whole = {"class": f"org.apache.spark.ml.regression.{kind.__name__}", **about, "uid": uid, "numTrees": len(learned)}
    spark.createDataFrame([(json.dumps(whole),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    each = [(i, json.dumps({"class": tree_kind, **about, "uid": f"dtr_{uuid.uuid4().hex[:12]}"}), w) for i, w in enumerate(weights)]
    spark.createDataFrame(each, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    nodes = [(i, n) for i, tree in enumerate(learned) for n in node_rows(tree, bins)]
    table = pa.table({"treeID": pa.array([i for i, _ in nodes], pa.int32()), "nodeData": pa.array([n for _, n in nodes], NODE_DATA)})
    spark.createDataFrame(table).write.parquet(f"{path}/data")
    return kind.load(path)


def _dense(estimator, dataset: DataFrame) -> bool:
    """Whether all features are plain numbers, and only what is learned here is asked for."""
    attributes = dataset.schema[estimator.getFeaturesCol()].metadata.get("ml_attr", {}).get("attrs", {})
    set_to = lambda name: estimator.hasParam(name) and estimator.isDefined(name) and estimator.getOrDefault(name)
    return not ({"binary", "nominal"} & set(attributes) or set_to("weightCol") or set_to("validationIndicatorCol")
                or set_to("minWeightFractionPerNode") or estimator.getImpurity() != "variance"
                or estimator.getMaxBins() > MOST_BINS or not 1 <= estimator.getMaxDepth() <= MOST_DEPTH
                or estimator.getFeatureSubsetStrategy() != "all")


class BoostedTrees(GBTRegressor):
    """``GBTRegressor`` that learns from binned rows."""

    def _fit(self, dataset: DataFrame) -> GBTRegressionModel:
        if not _dense(self, dataset) or self.getLossType() != "squared" or self.getSubsamplingRate() != 1.0:
            return super()._fit(dataset)
        spark, depth = dataset.sparkSession, self.getMaxDepth()
        with scratch_tables(spark):
            rows = binned(dataset, self.getFeaturesCol(), self.getLabelCol(), self.getMaxBins(), self.getSeed())
            if rows is None:
                return super()._fit(dataset)
            learned = boost(rows, spark, self.getMaxIter(), depth, self.getStepSize(), self.getMinInstancesPerNode(),
                            self.getMinInfoGain())
            weights = [1.0] + [self.getStepSize()] * (len(learned) - 1)
            return self._copyValues(as_model(GBTRegressionModel, learned, weights, rows.bins, spark, self.uid, depth))


class BaggedTrees(RandomForestRegressor):
    """``RandomForestRegressor`` that learns from binned rows."""

    def _fit(self, dataset: DataFrame) -> RandomForestRegressionModel:
        whole = not self.getBootstrap()
        if not _dense(self, dataset) or (whole and self.getSubsamplingRate() != 1.0):
            return super()._fit(dataset)
        spark, depth = dataset.sparkSession, self.getMaxDepth()
        with scratch_tables(spark):
            rows = binned(dataset, self.getFeaturesCol(), self.getLabelCol(), self.getMaxBins(), self.getSeed())
            if rows is None:
                return super()._fit(dataset)
            learned = forest(rows, spark, self.getNumTrees(), depth, None if whole else self.getSubsamplingRate(), self.getSeed(),
                             self.getMinInstancesPerNode(), self.getMinInfoGain())
            return self._copyValues(as_model(RandomForestRegressionModel, learned, [1.0] * len(learned), rows.bins, spark, self.uid, depth))
