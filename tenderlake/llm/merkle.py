"""Merkle manifest of a table, with a witness for every row, built by streaming aligned appends.

Rows are numbered inside their group and cut into aligned blocks of
``FAN ** DEPTH`` of them. A task appends the rows of a block one by one. Each
open subtree carries the partial witness of what is below it; when its run of
siblings is complete, the witness is extended by them, for all rows below at
once. The root of a block is then one more append to the next higher table of
blocks, until a group has a single node. The roots of the groups are appended
to one last tree in the same way. On the way down every block hands its own
witness to its rows, so no task holds more than one block.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenderlake.llm.common import chunks, stored

#: Nodes hashed together, and levels of a block.
FAN, DEPTH = 8, 4

STEPS = "array<struct<left:string,right:string>>"


def digest(*texts: str) -> str:
    return sha256("".join(texts).encode()).hexdigest()


def field(name: str) -> Column:
    """A value as it enters a leaf: ``-`` if null, else its length in UTF-8 bytes, a colon and the value."""
    value = F.col(name).cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*fields).cast("binary"), 256)


class Subtree:
    """A node whose leaves share what their witnesses gain from here on."""

    __slots__ = ("node", "children", "step")

    def __init__(self, node: str, children: list[Subtree]):
        self.node, self.children, self.step = node, children, None

    def witnesses(self, above: tuple = ()) -> Iterator[tuple]:
        """Steps (left siblings, right siblings) of each leaf below, from the leaf upwards, ending with ``above``."""
        mine = above if self.step is None else (self.step, *above)
        if not self.children:
            yield mine
        for child in self.children:
            yield from child.witnesses(mine)


class Block:
    """Appends nodes to one aligned block; ``close`` completes the runs that are still open."""

    def __init__(self, levels: int, fan: int = FAN):
        self.fan, self.open = fan, [[] for _ in range(levels + 1)]

    def append(self, node: str) -> None:
        self._add(0, Subtree(node, []))

    def _add(self, level: int, tree: Subtree) -> None:
        self.open[level].append(tree)
        if len(self.open[level]) == self.fan and level < len(self.open) - 1:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        nodes = [t.node for t in run]
        for k, tree in enumerate(run):
            tree.step = ("".join(nodes[:k]), "".join(nodes[k + 1:]))
        self._add(level + 1, Subtree(digest(*nodes), run))

    def close(self) -> Subtree:
        for level in range(len(self.open) - 1):
            if self.open[level]:
                self._complete(level)
        return self.open[-1][0]


def levels_of(total: int, fan: int = FAN, depth: int = DEPTH) -> int:
    """Levels that a block adds in a group of ``total`` nodes: up to one node, or those of a whole block."""
    levels = 0
    while total > 1 and levels < depth:
        total, levels = -(-total // fan), levels + 1
    return levels


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole blocks from batches sorted by (grp, block), and where each block begins and ends."""
    rest = None

    def edges(part: pa.Table) -> np.ndarray:
        keys = list(zip(part.column("grp").to_pylist(), part.column("block").to_pylist()))
        return np.array([0, *(k for k in range(1, len(keys)) if keys[k] != keys[k - 1]), len(keys)])

    for part in chunks(batches, 20_000):
        part = part if rest is None else pa.concat_tables([rest, part])
        cuts = edges(part)
        if len(cuts) > 2:
            yield part.slice(0, cuts[-2]), cuts[:-1]
        rest = part.slice(cuts[-2])
    if rest is not None:
        yield rest, np.array([0, rest.num_rows])


def _append(nodes: list[str], total: int, fan: int, depth: int) -> Subtree:
    block = Block(levels_of(total, fan, depth), fan)
    for node in nodes:
        block.append(node)
    return block.close()


def _roots(nodes: DataFrame, fan: int, depth: int) -> DataFrame:
    """(grp, position, total, node) of the blocks of ``nodes``, which are the next higher nodes."""
    size = fan ** depth

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, cuts in _blocks(batches):
            names, totals = part.column("node").to_pylist(), part.column("total").to_pylist()
            first = pa.array(cuts[:-1])
            yield pa.RecordBatch.from_arrays(
                [part.column("grp").take(first).combine_chunks(), part.column("block").take(first).combine_chunks(),
                 pa.array([-(-totals[i] // size) for i in cuts[:-1]], pa.int64()),
                 pa.array([_append(names[i:j], totals[i], fan, depth).node for i, j in zip(cuts, cuts[1:])], pa.string())],
                ["grp", "position", "total", "node"])

    rows = nodes.select("grp", F.floor(F.col("position") / size).alias("block"), "position", "total", "node")
    return rows.repartition("grp", "block").sortWithinPartitions("grp", "block", "position").mapInArrow(
        run, "grp string, position long, total long, node string")


def _witnessed(nodes: DataFrame, above: DataFrame, fan: int, depth: int) -> DataFrame:
    """(grp, position, node, row, witness, subroot, root) of ``nodes``.

    ``above``: (grp, position, witness, subroot, root) of their blocks. Each
    block's row of ``above`` is sorted before the rows of the block.
    """
    size = fan ** depth

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, cuts in _blocks(batches):
            names, totals = part.column("node").to_pylist(), part.column("total").to_pylist()
            heads = {k: part.column(k).take(pa.array(cuts[:-1])).to_pylist() for k in ("witness", "subroot", "root")}
            kept = np.ones(part.num_rows, bool)
            kept[cuts[:-1]] = False
            out, subroots, roots = [], [], []
            for k, (i, j) in enumerate(zip(cuts, cuts[1:])):
                over = tuple((s["left"], s["right"]) for s in heads["witness"][k])
                if j > i + 1:
                    out += _append(names[i + 1:j], totals[i + 1], fan, depth).witnesses(over)
                subroots += [heads["subroot"][k]] * (j - i - 1)
                roots += [heads["root"][k]] * (j - i - 1)
            sizes = np.fromiter(map(len, out), np.int64, len(out))
            steps = pa.StructArray.from_arrays([pa.array([s[side] for w in out for s in w], pa.string()) for side in (0, 1)],
                                               ["left", "right"])
            rows = part.filter(pa.array(kept)).combine_chunks()
            columns = [rows.column(c) for c in ("grp", "position", "node", "row")]
            columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), steps),
                 pa.array(subroots, pa.string()), pa.array(roots, pa.string())],
                ["grp", "position", "node", "row", "witness", "subroot", "root"])

    kind = nodes.schema["row"].dataType.simpleString()
    none = lambda t, name: F.lit(None).cast(t).alias(name)
    lower = nodes.select("grp", F.floor(F.col("position") / size).alias("block"), "position", "total", "node", "row",
                         none(STEPS, "witness"), none("string", "subroot"), none("string", "root"))
    upper = above.select("grp", F.col("position").alias("block"), F.lit(-1).cast("long").alias("position"),
                         none("long", "total"), none("string", "node"), none(kind, "row"), "witness", "subroot", "root")
    return lower.unionByName(upper).repartition("grp", "block").sortWithinPartitions("grp", "block", "position").mapInArrow(
        run, f"grp string, position long, node string, row {kind}, witness {STEPS}, subroot string, root string")


def _numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with the position in their ``grp`` and its number of rows, counted from slices of a sorted table.

    Rows equal in all of ``order`` are spread by their place in the input, so
    they do not meet in one task.
    """
    sort = ["grp", *order, "place"]
    placed = stored(rows.withColumn("place", F.monotonically_increasing_id()).repartitionByRange(*sort)
                    .sortWithinPartitions(*sort).drop("place").withColumn("part", F.spark_partition_id())
                    .withColumn("slot", F.monotonically_increasing_id()), "placed")
    inside = Window.partitionBy("grp")
    before = inside.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    slices = placed.groupBy("grp", "part").agg(F.count(F.lit(1)).alias("n"), F.min("slot").alias("first")).select(
        F.col("grp").alias("g"), F.col("part").alias("p"), F.sum("n").over(inside).alias("total"),
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return placed.join(slices, (F.col("part") == F.col("p")) & F.col("grp").eqNullSafe(F.col("g"))).select(
        *rows.columns, (F.col("slot") + F.col("shift")).alias("position"), "total")


def _climb(nodes: DataFrame, fan: int, depth: int) -> tuple[list[DataFrame], DataFrame]:
    """The tables of nodes from the leaves up, and the last one, which has a node for each group."""
    tables = [nodes]
    while True:
        top = stored(_roots(tables[-1], fan, depth), "block-roots")
        if (top.agg(F.max("total")).first()[0] or 0) <= 1:
            return tables, top
        tables.append(top.withColumn("row", F.lit(None).cast("struct<none:string>")))


def manifest(leaves: DataFrame, group: str, order: list[str], fan: int = FAN, depth: int = DEPTH) -> DataFrame:
    """(grp, position, node, row, witness, subroot, root) of every row of ``leaves``.

    ``leaves`` has a column ``leaf`` (hex digest); its other columns are kept
    in the struct ``row``. Leaves of a group ascend by ``order`` (nulls first),
    ties by their digest. While a group has several nodes, each ``fan``
    consecutive ones become their hash; what remains is its subroot. Groups
    ascend by their UTF-8 bytes, null first, and become the root likewise.
    ``witness`` lists the siblings left and right, concatenated, level by level
    from the leaf through the subroot to the root. An empty table has no root
    and gives no row.
    """
    keep = F.struct(*[c for c in leaves.columns if c != "leaf"]).alias("row")
    rows = stored(leaves.select(F.col(group).cast("string").alias("grp"), *(F.col(c).alias(f"by_{k}") for k, c in enumerate(order)),
                                F.col("leaf").alias("node"), keep), "leaves")
    nodes = stored(_numbered(rows, [f"by_{k}" for k in range(len(order))] + ["node"]), "leaf-nodes")
    tables, subroots = _climb(nodes, fan, depth)
    # The trees of the groups are the leaves of the last one.
    trees = subroots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "node",
                            F.struct(F.col("grp").alias("grp"), F.col("node").alias("subroot")).alias("row"))
    over, roots = _climb(stored(_numbered(trees, ["name"]), "tree-nodes"), fan, depth)
    above = roots.select("grp", "position", F.array().cast(STEPS).alias("witness"), F.lit(None).cast("string").alias("subroot"),
                         F.col("node").alias("root"))
    for table in reversed(over):
        above = stored(_witnessed(table, above, fan, depth), "tree-witnesses")
    above = above.select("row.grp", F.lit(0).cast("long").alias("position"), "witness", "row.subroot", "root")
    for table in reversed(tables[1:]):
        above = stored(_witnessed(table, above, fan, depth), "block-witnesses")
    return _witnessed(tables[0], above, fan, depth)


def folded(start: Column, witness: Column) -> Column:
    """The root that a leaf and its witness lead to."""
    return F.aggregate(witness, start, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]).cast("binary"), 256))


def proof_digest(witness: Column) -> Column:
    """Hash of all siblings of a witness, in its order."""
    return F.sha2(F.array_join(F.transform(witness, lambda s: F.concat(s["left"], s["right"])), "").cast("binary"), 256)


CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def check_tampering(docs: DataFrame) -> DataFrame:
    """Manifest of ``documents`` by language, and its check after some texts were lower-cased.

    (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every
    row. Tampered are the texts of rows where 3 divides the CRC-32 of doc_id in
    decimal; a row without doc_id is not. A row whose text has no capitals
    stays as it is, and verifies.
    """
    head = [field(c) for c in ("doc_id", "source", "lang", "n_chars")]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    lowered = F.when(hit, F.translate("text", CAPITALS, SMALL))
    rows = docs.select("doc_id", "source", "lang", "n_chars", "text", hit.alias("hit"), lowered.alias("lowered"))
    leaves = rows.select("doc_id", "lang", leaf([*head, field("text")]).alias("leaf"),
                         F.when(F.col("hit"), leaf([*head, field("lowered")])).alias("tampered"))
    found = manifest(leaves, "lang", ["doc_id"])
    back = folded(F.coalesce("row.tampered", "node"), F.col("witness"))
    return found.select("row.doc_id", F.col("node").alias("leaf"), "subroot", "root",
                        proof_digest(F.col("witness")).alias("proof_sha256"), back.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))
