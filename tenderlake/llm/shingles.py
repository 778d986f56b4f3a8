"""Near duplicates by SimHash links first, completed to all pairs of a Jaccard similarity by prefix filtering.

Texts whose fingerprints are tied by deletion variants (operator 1) are each
verified against the first of their group, on the whole shingle sets. That
joins most near copies at the cost of one comparison a text. Fingerprints tell
little about pairs near the similarity of 0.8, so the rest is found by an exact
join: two sets of that similarity share most of their shingles. With the
shingles of every set in one common order, the first shared one stands among
the first fifth of both, so only those are indexed. Members of a key group that
are not yet in one component are compared with a pivot, and what is then still
apart is compared pair by pair. Every link is verified on the whole sets.

The order puts shingles first that are rare in a sample: it decides how many
pairs meet for nothing, never which pairs are found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake.llm import hashing
from tenderlake.llm.common import binary_text, column, give_back, made, release, stored, text_batches, text_bytes, whole_groups
from tenderlake.llm.components import connected_components
from tenderlake.llm.simhash import fingerprint, links, shingle_hashes

#: Documents that tell which shingles are common, and how many of these shingles are known.
SAMPLE, COMMON = 20_000, 400_000
#: Key groups up to this size have one member compared with all the others first, larger ones so many.
BULK, PIVOTS = 48, 4
#: Texts compared with one pivot by one task.
SHARE = 2_000
#: Cells over which a set's shingles are counted, two to a byte, and the count that stands for itself and any larger one.
CELLS, FULL = 256, 15


def shingle_set(text: bytes, width: int) -> np.ndarray:
    return np.unique(shingle_hashes(text, width, 64))


def cell_counts(found: np.ndarray) -> bytes:
    """Shingles of a set by cell, up to ``FULL``."""
    counts = np.minimum(np.bincount((found >> np.uint64(56)).astype(np.int64), minlength=CELLS), FULL).astype(np.uint8)
    return (counts[::2] << 4 | counts[1::2]).tobytes()


def similar(shared, n, m):
    """Whether so many shared shingles of n and m are a similarity of 0.8 or more."""
    return 9 * shared >= 4 * (n + m)


def _common(docs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles met more than once in a sample, ascending, and how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches):
            found = [shingle_set(t, width) for t in text_bytes(batch.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).astype(np.int64))], ["key"])

    one_of = max(1, docs.count() // SAMPLE)
    sample = docs.where(F.pmod(F.xxhash64("id"), F.lit(one_of)) == 0).select("text")
    counts = sample.mapInArrow(run, "key long").groupBy("key").count().where("count > 1").orderBy(
        F.desc("count"), "key").limit(COMMON).toArrow()
    keys, n = counts.column("key").to_numpy().astype(np.uint64), counts.column("count").to_numpy()
    order = np.argsort(keys)
    return keys[order], n[order]


def _prefix(hashes: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The rarest fifth of a set, rarest first."""
    n = len(hashes)
    rank = np.zeros(n, np.int64)
    if len(keys):
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        rank = np.where(keys[at] == hashes, counts[at], 0)
    return hashes[np.lexsort((hashes, rank))][:n - -(-4 * n // 5) + 1 if n else 0]


def _sets(docs: DataFrame, width: int, common) -> DataFrame:
    """(id, name, n, fp0, cells, keys): the set's hash and size, fingerprint, shingles by cell, and shingles it is indexed under."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = common.value
        for batch in text_batches(batches):
            rows = []
            for text in text_bytes(batch.column(1)):
                hashes = shingle_hashes(text, width, 64)
                found = np.unique(hashes)
                rows.append((xxhash.xxh3_128_digest(found.tobytes()), len(found), int(fingerprint(hashes)[0].astype(np.int64)),
                             cell_counts(found), _prefix(found, *known).tobytes()))
            kinds = (pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0)] + [pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)],
                                             ["id", "name", "n", "fp0", "cells", "keys"])

    return docs.mapInArrow(run, "id long, name binary, n long, fp0 long, cells binary, keys binary")


MEMBERS = "key long, row long, n long, pos long"


def _shared(firsts: DataFrame) -> DataFrame:
    """(key, row, n, pos) of the keys that several rows are indexed under."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                keys = [np.frombuffer(k, np.int64) for k in part.column("keys").to_pylist()]
                sizes = np.fromiter(map(len, keys), np.int64, len(keys))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys)), *(pa.array(np.repeat(column(part, c), sizes)) for c in ("row", "n")),
                     pa.array(np.concatenate([np.arange(s) for s in sizes]))], ["key", "row", "n", "pos"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole_groups(batches, "key"):
            key, row = column(part, "key"), column(part, "row")
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            sizes = np.diff(np.append(starts, len(key)))
            several = np.repeat(np.minimum.reduceat(row, starts) != np.maximum.reduceat(row, starts), sizes)
            yield from part.filter(pa.array(several)).combine_chunks().to_batches()

    indexed = firsts.select("row", "n", "keys").mapInArrow(index, MEMBERS)
    return indexed.repartition("key").sortWithinPartitions("key", "n", "row").mapInArrow(meet, MEMBERS)


class Members:
    """Members of whole key groups, ascending by key and then by n."""

    def __init__(self, part: pa.Table):
        self.key, self.rep, self.n, self.pos, self.label = (column(part, c) for c in ("key", "rep", "n", "pos", "label"))
        packed = np.frombuffer(b"".join(part.column("cells").to_pylist()), np.uint8).reshape(-1, CELLS // 2)
        self.cells = np.concatenate([packed >> 4, packed & 15], axis=1)
        self.starts = np.flatnonzero(np.concatenate([[True], self.key[1:] != self.key[:-1]]))
        self.sizes = np.diff(np.append(self.starts, len(self.key)))

    def candidates(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those of the pairs (i, j) that are apart and may be similar.

        Beside the places in the order, the counts of the shingles by cell
        bound what two sets can share, unless a cell is full in both.
        """
        n, pos = self.n, self.pos
        good = (self.label[i] != self.label[j]) & similar(np.minimum(n[i] - pos[i], n[j] - pos[j]), n[i], n[j])
        i, j = i[good], j[good]
        kept = [np.empty(0, bool)]
        for at in range(0, len(i), 1 << 15):
            x, y = i[at:at + (1 << 15)], j[at:at + (1 << 15)]
            both = np.minimum(self.cells[x], self.cells[y])
            shared = np.where(both.max(axis=1, initial=0) < FULL, both.sum(axis=1, dtype=np.int64), np.minimum(n[x], n[y]))
            kept.append(similar(shared, n[x], n[y]))
        good = np.concatenate(kept)
        return self.rep[i[good]], self.rep[j[good]]

    def with_pivots(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of a group's pivots with its members; the same members are pivots under all keys."""
        group = np.repeat(np.arange(len(self.starts)), self.sizes)
        order = np.lexsort((hashing.mixed(self.rep.astype(np.uint64)), group))
        for rank in range(PIVOTS):
            asked = np.flatnonzero(self.sizes > (1 if rank == 0 else BULK))
            pivot = order[self.starts[asked] + rank] if len(asked) else asked
            member = np.flatnonzero(np.isin(group, asked)) if rank else np.flatnonzero(self.sizes[group] > 1)
            yield self.candidates(np.repeat(pivot, self.sizes[asked]), member)

    def of_each_other(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All pairs inside groups."""
        group = np.repeat(np.arange(len(self.starts)), self.sizes)
        small = np.flatnonzero(self.sizes[group] <= BULK)
        for step in range(1, BULK):
            i, j = small[:-step], small[step:]
            same = group[i] == group[j]
            if not same.any():
                break
            yield self.candidates(i[same], j[same])
        for k in np.flatnonzero(self.sizes > BULK):
            begin, end = self.starts[k], self.starts[k] + self.sizes[k]
            if (self.label[begin:end] == self.label[begin]).all():
                continue
            for i in range(begin, end - 1):
                j = np.arange(i + 1, np.searchsorted(self.n[i + 1:end], 5 * self.n[i] // 4, side="right") + i + 1)
                yield self.candidates(np.full(len(j), i), j)


def _apart(members: DataFrame, pivots: bool) -> DataFrame:
    """Pairs (a, b) of key groups that are not in one component yet and could be similar; with ``pivots`` those with a pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole_groups(batches, "key"):
            held, n = [], 0
            own = Members(part)
            for pair in own.with_pivots() if pivots else own.of_each_other():
                held.append(np.stack([np.minimum(*pair), np.maximum(*pair)], axis=1)[pair[0] != pair[1]])
                n += len(held[-1])
                if n > 1 << 20:
                    yield _pairs(held)
                    held, n = [], 0
            if n:
                yield _pairs(held)

    labelled = members.repartition("key").sortWithinPartitions("key", "n", "rep")
    return labelled.mapInArrow(run, "a long, b long").distinct()


def _pairs(held: list[np.ndarray]) -> pa.RecordBatch:
    found = np.unique(np.concatenate(held), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])


def _verified(pairs: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """The pairs (stored, distinct) whose sets have a similarity of 0.8 or more.

    A text is sent once to each ``a`` that it is compared with, behind the text
    of ``a``; more than ``SHARE`` texts of one ``a`` are dealt to several tasks.
    """

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, pivots = None, []
        for batch in text_batches(batches):
            good = []
            for k, (a, slot, member, text) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("a", "slot", "member", "text")))):
                if at != (a, slot):
                    at, pivots = (a, slot), []
                own = shingle_set(text, width)
                if not member:
                    pivots.append(own)
                elif any(similar(len(np.intersect1d(own, x, assume_unique=True)), len(own), len(x)) for x in pivots):
                    good.append(k)
            yield batch.select(["a", "id"]).take(pa.array(good, pa.int64())).rename_columns(["a", "b"])

    size = stored(pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / SHARE).alias("slots")), "near-slots")
    first = size.select(F.col("a").alias("id"), "a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1)).alias("slot"),
                        F.lit(False).alias("member"))
    other = pairs.join(size, "a").select(F.col("b").alias("id"), "a", F.pmod(F.xxhash64("b"), F.col("slots")).alias("slot"),
                                         F.lit(True).alias("member"))
    wanted = stored(first.unionByName(other), "near-wanted")
    sent = docs.join(wanted, "id").select("a", "slot", "member", "id", "text")
    return stored(sent.repartition("a", "slot").sortWithinPartitions("a", "slot", "member").mapInArrow(verify, "a long, b long")
                  .distinct(), "near-links")


def near_duplicates(docs: DataFrame, width: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, component) of every row with an id: the smallest id reached by links of similarity 0.8 or more.

    Words are split at ASCII white space, A-Z lower-cased; a text of fewer
    words than ``width`` is one shingle. Texts without words have no shingle
    and are linked only with each other. Rows of one id are one document,
    linked by any of their texts.
    """
    mark = made()
    given = docs.select(F.col(id_col).cast("long").alias("id"), binary_text(text_col).alias("text")).where("id is not null")
    common = docs.sparkSession.sparkContext.broadcast(_common(given, width))
    give_back()
    sets = stored(_sets(given, width, common).withColumn("row", F.monotonically_increasing_id()), "near-sets")
    # Equal sets are one class, spoken for by one row of the smallest id.
    classes = stored(sets.groupBy("name").agg(F.min(F.struct("id", "row")).alias("first")).select(
        "name", F.col("first.id").alias("rep"), "first.row"), "near-classes")
    firsts = sets.where("n > 0").join(classes.select("row", "rep"), "row")
    heads = stored(firsts.select("row", "rep", "fp0", "cells"), "near-heads")

    # Texts of near fingerprints, each against the first of its group.
    prints = stored(heads.groupBy("fp0").agg(F.min("rep").alias("rep")), "near-prints")
    groups = stored(connected_components(links(prints, 64, 3)), "near-groups")
    label = prints.join(groups, prints.rep == groups.node, "left").select("fp0", F.coalesce("component", "rep").alias("a"))
    close = stored(heads.join(label, "fp0").select("a", F.col("rep").alias("b")).where("a <> b").distinct(), "near-close")
    tied_by = _verified(close, given, width)

    # What these links leave apart, exactly.
    members = stored(_shared(firsts), "near-members")
    tested = close
    for pivots in (True, False):
        # What is tied already goes on as stars, which take fewer rounds than all links again.
        parts = stored(connected_components(tied_by).distinct(), "near-parts")
        seen = heads.join(parts, F.col("rep") == F.col("node"), "left").select(
            "row", "rep", "cells", F.coalesce("component", "rep").alias("label"))
        pairs = stored(_apart(members.join(seen, "row"), pivots).join(
            tested.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"), "near-pairs")
        tied = parts.select(F.col("node").alias("a"), F.col("component").alias("b"))
        tied_by = tied.unionAll(_verified(pairs, given, width))
        tested = tested.unionAll(pairs)

    # An id with several texts ties their classes together.
    own = sets.select("id", "name").join(classes.select("name", "rep"), "name").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    joined = connected_components(tied_by.unionAll(own))
    ids = sets.select("id")
    result = stored(ids.join(joined, ids.id == joined.node, "left").select("id", F.coalesce("component", "id").alias("component")),
                    "near-components")
    release(result, mark)
    return result
