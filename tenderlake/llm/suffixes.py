"""Exact removal of repeated byte strings by a sparse, hash-compared suffix sort.

Sorting every suffix of a corpus would move each byte tens of times. Here only
suffixes at anchors are sorted: of each string of ``length`` bytes the anchor
is the place of its smallest hashed gram, so equal strings have their anchors
at the same place, and about one byte in 18 is one.

1. Grams at anchors are brought together by hash; those of one document only
   drop out.
2. The remaining anchors send their surroundings, up to ``length`` bytes to
   either side, once for each different one in a block of documents.
3. Surroundings of equal grams are sorted rightwards and leftwards by
   mergesort. Two are compared by the length of their common extension, found
   by binary search over prefix polynomial hashes; the sorted order and the
   extensions of neighbours are then verified on the bytes. Runs of long
   enough extensions tell which strings are equal and the first document that
   has each.
4. Documents cover the strings that an earlier document has.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenderlake.llm import hashing
from tenderlake.llm.common import binary_text, give_back, stored, text_batches, text_bytes

#: Ids of documents without one: they come last and remove nothing from others.
LAST = np.iinfo(np.int64).max
#: Text of one block of documents, and anchors that a task holds before it hands them on.
BLOCK_BYTES, HELD = 3 << 20, 1_000_000
#: Blocks at least. What blocks and buckets exchange is one row for each pair of them that shares an anchor.
FEWEST = 24


@dataclass(frozen=True)
class Layout:
    """length: bytes of a repeated string; gram: bytes of an anchor; parts: blocks of documents, buckets of grams."""

    length: int
    parts: int

    @property
    def gram(self) -> int:
        return max(16, self.length - 62)

    @property
    def reach(self) -> int:
        return self.length - self.gram


# -- packing of arrays and documents ------------------------------------------------------------------------------


def _codec() -> pa.Codec:
    return pa.Codec("zstd", compression_level=3)


def _blob(*arrays: np.ndarray) -> bytes:
    """Arrays of one length, each as byte planes, compressed together."""
    planes = b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T.tobytes() for a in arrays)
    size = np.array([len(arrays[0]), len(planes)], "<u8").tobytes()
    return size + pa.compress(planes, "zstd", asbytes=True)


def _unblob(data: bytes, *kinds: str) -> list[np.ndarray]:
    n, size = np.frombuffer(data, "<u8", 2).tolist()
    planes = np.frombuffer(pa.decompress(data[16:], size, "zstd", asbytes=True), np.uint8)
    out, at = [], 0
    for kind in kinds:
        width = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(planes[at:at + n * width].reshape(width, n).T).view(kind).reshape(n))
        at += n * width
    return out


def _joined(column, *kinds: str) -> list[np.ndarray]:
    parts = [_unblob(x.as_buffer().to_pybytes(), *kinds) for x in column]
    return [np.concatenate(c) for c in zip(*parts)] if parts else [np.empty(0, k) for k in kinds]


def _steps(sorted_ids: np.ndarray) -> np.ndarray:
    return np.diff(sorted_ids.astype(np.int64), prepend=np.int64(0))


def _block_of(ids: np.ndarray, parts: int) -> np.ndarray:
    return (hashing.mixed(ids.astype(np.uint64) + np.uint64(1)) % np.uint64(parts)).astype(np.int64)


def _orders(column: pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(LAST).to_numpy(zero_copy_only=False)


def _split(keys: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """(part, places of its keys) of the parts that have any."""
    order = np.argsort(keys, kind="stable")
    edges = np.searchsorted(keys[order], np.arange(parts + 1))
    for k in np.flatnonzero(np.diff(edges)):
        yield int(k), order[edges[k]:edges[k + 1]]


def _packs(docs: DataFrame, layout: Layout) -> DataFrame:
    """(part, kind, data): whole rows of ``docs`` (order, octets, others) for each block, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks()
            parts, data = [], []
            for part, own in _split(_block_of(rows.column("order").to_numpy(), layout.parts), layout.parts):
                out = pa.BufferOutputStream()
                with pa.ipc.new_stream(out, rows.schema, options=pa.ipc.IpcWriteOptions(compression=_codec())) as writer:
                    writer.write_table(rows.take(pa.array(own)))
                parts.append(part)
                data.append(out.getvalue().to_pybytes())
            return _rows(parts, "docs", data)

        for batch in text_batches(batches):
            held.append(batch)
            size += batch.nbytes
            if size >= 4 * BLOCK_BYTES:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    return docs.mapInArrow(run, PARTED)


PARTED = "part long, kind string, data binary"


def _rows(parts: list[int], kind: str, data: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(parts, pa.int64()), pa.array([kind] * len(parts), pa.string()),
                                       pa.array(data, pa.binary())], ["part", "kind", "data"])


class Block:
    """Documents of one block in order of id and text, their bytes in one array."""

    def __init__(self, packs: pa.Table):
        tables = [pa.ipc.open_stream(x.as_buffer()).read_all() for x in packs.column("data")]
        rows = pa.concat_tables(tables) if tables else None
        texts = rows.column("octets").to_pylist() if tables else []
        orders = rows.column("order").to_pylist() if tables else []
        sequence = sorted(range(len(texts)), key=lambda k: (orders[k], texts[k]))
        self.rows = rows.take(pa.array(sequence, pa.int64())) if tables else None
        self.texts = [texts[k] for k in sequence]
        self.orders = np.array([orders[k] for k in sequence], np.int64)
        self.octets = np.frombuffer(b"".join(self.texts), np.uint8)
        self.ends = np.cumsum(np.fromiter(map(len, self.texts), np.int64, len(texts)))
        self.starts = self.ends - np.fromiter(map(len, self.texts), np.int64, len(texts))

    def surroundings(self, order: np.ndarray, pos: np.ndarray, layout: Layout) -> dict[str, np.ndarray]:
        """Of each anchor: place, bytes to the left and right, hash, and the anchors that show each hash first."""
        first = np.searchsorted(self.orders, order, side="left")
        rows = np.searchsorted(self.orders, order, side="right") - first  # documents of one id share their anchors
        at = np.repeat(first, rows) + np.arange(rows.sum()) - np.repeat(np.cumsum(rows) - rows, rows)
        place = self.starts[at] + np.repeat(pos, rows)
        inside = place + layout.gram <= self.ends[at]
        at, place = at[inside], place[inside]
        left = np.minimum(layout.reach, place - self.starts[at])
        right = np.minimum(layout.reach, self.ends[at] - place - layout.gram)
        sums = hashing.prefix(self.octets)
        whole = hashing.mixed(hashing.substrings(sums, place - left, place + layout.gram + right)
                              + (left * 64 + right).astype(np.uint64) * np.uint64(hashing.BASE))
        while True:
            own = np.lexsort((place, self.orders[at], whole))
            name = np.flatnonzero(np.concatenate([[True], whole[own][1:] != whole[own][:-1]])) if len(own) else own
            group = np.zeros(len(own), np.int64)
            group[own] = np.repeat(np.arange(len(name)), np.diff(np.append(name, len(own))))
            lead = own[name]  # of each hash the anchor in the first document
            other = _differing(self.octets, place, left, right, lead[group], layout)
            if not len(other):
                break
            # Two surroundings of one hash: those that differ from the first are named by another hash of their bytes.
            windows = _window(self.octets, place[other], left[other], right[other], layout)
            whole[other] = [xxhash.xxh3_64_intdigest(w.tobytes(), int(h) & 0xFFFFFFFF) for w, h in zip(windows, whole[other])]
        return {"place": place, "left": left, "right": right, "order": self.orders[at], "hash": whole, "lead": lead,
                "group": group, "gram": hashing.mixed(hashing.substrings(sums, place, place + layout.gram))}


def _differing(octets: np.ndarray, place, left, right, lead, layout: Layout) -> np.ndarray:
    """Those whose surroundings are not, byte by byte, the ones of their ``lead``."""
    found = [np.empty(0, np.int64)]
    for at in range(0, len(place), 1 << 15):
        own = np.arange(at, min(at + (1 << 15), len(place)))
        own = own[lead[own] != own]
        same = (left[own] == left[lead[own]]) & (right[own] == right[lead[own]])
        same &= (_window(octets, place[own], left[own], right[own], layout) ==
                 _window(octets, place[lead[own]], left[lead[own]], right[lead[own]], layout)).all(axis=1)
        found.append(own[~same])
    return np.concatenate(found)


def _window(octets: np.ndarray, place: np.ndarray, left: np.ndarray, right: np.ndarray, layout: Layout) -> np.ndarray:
    """One row of 2 * reach + gram bytes around each anchor, zero outside the document."""
    step = np.arange(-layout.reach, layout.gram + layout.reach)
    out = np.zeros((len(place), len(step)), np.uint8)
    for at in range(0, len(place), 1 << 13):
        own = slice(at, at + (1 << 13))
        known = (step >= -left[own, None]) & (step < layout.gram + right[own, None])
        out[own][known] = octets[(place[own, None] + step)[known]]
    return out


# -- 1: anchors ---------------------------------------------------------------------------------------------------


def anchors(octets: np.ndarray, starts: np.ndarray, ends: np.ndarray, layout: Layout) -> tuple[np.ndarray, np.ndarray]:
    """Places and gram hashes of the anchors of all strings of ``length`` bytes that lie inside a document."""
    if len(octets) < layout.length:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    grams = hashing.mixed(hashing.windows(hashing.prefix(octets), layout.gram))
    # Smallest upper half, leftmost of equals: decided by the string alone.
    ranked = grams & np.uint64(0xFFFFFFFF00000000) | np.arange(len(grams), dtype=np.uint64)
    width, done = layout.reach + 1, 1
    while 2 * done <= width:
        ranked = np.minimum(ranked[:-done], ranked[done:])
        done *= 2
    if done < width:
        ranked = np.minimum(ranked[:len(ranked) - (width - done)], ranked[width - done:])
    inside = np.zeros(len(octets) + 1, np.int64)
    whole = ends - starts >= layout.length
    np.add.at(inside, starts[whole], 1)
    np.add.at(inside, ends[whole] - layout.length + 1, -1)
    place = (ranked[np.cumsum(inside)[:len(ranked)] > 0] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    if len(place):
        place = place[np.concatenate([[True], place[1:] != place[:-1]])]
    return place, grams[place]


def _anchor_rows(docs: DataFrame, layout: Layout) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush() -> pa.RecordBatch:
            order, pos, gram = (np.concatenate(c) for c in zip(*held))
            sequence = np.lexsort((pos, order))
            order, pos, gram = order[sequence], pos[sequence], gram[sequence]
            # Five bytes of the gram's hash tell grams of one bucket apart; what they mix up is found out later.
            gram = hashing.mixed(gram)
            parts, data = [], []
            for part, own in _split((gram % np.uint64(layout.parts)).astype(np.int64), layout.parts):
                tags = (gram[own] >> np.uint64(24)).astype("<u8")
                data.append(_blob(_steps(order[own]), pos[own].astype("<u4"), tags.astype("<u4"),
                                  (tags >> np.uint64(32)).astype(np.uint8)))
                parts.append(part)
            return _rows(parts, "anchors", data)

        for batch in text_batches(batches, 1 << 20):
            texts = text_bytes(batch.column("octets"))
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            ends = np.cumsum(sizes)
            place, gram = anchors(np.frombuffer(b"".join(texts), np.uint8), ends - sizes, ends, layout)
            row = np.searchsorted(ends, place, side="right")
            order = batch.column("order").to_numpy(zero_copy_only=False)
            held.append((order[row], place - (ends - sizes)[row], gram))
            n += len(place)
            if n >= HELD:
                yield flush()
                held, n = [], 0
        if n:
            yield flush()

    return docs.select("order", "octets").mapInArrow(run, PARTED)


def _candidates(layout: Layout):
    """Anchors whose gram other documents have too, for each block of documents."""

    def run(part: pa.Table) -> pa.Table:
        order, pos, tag = [], [], []
        for x in part.column("data"):
            steps, where, low, high = _unblob(x.as_buffer().to_pybytes(), "<i8", "<u4", "<u4", "u1")
            order.append(np.cumsum(steps))
            pos.append(where)
            tag.append(high.astype(np.uint64) << np.uint64(32) | low.astype(np.uint64))
        order, pos, tag = map(np.concatenate, (order, pos, tag))
        own = np.argsort(tag, kind="stable")
        starts = np.flatnonzero(np.concatenate([[True], tag[own][1:] != tag[own][:-1]]))
        sizes = np.diff(np.append(starts, len(own)))
        shared = np.minimum.reduceat(order[own], starts) != np.maximum.reduceat(order[own], starts)
        own = own[np.repeat(shared, sizes)]
        order, pos = order[own], pos[own]
        sequence = np.lexsort((pos, order))
        order, pos = order[sequence], pos[sequence]
        parts, data = [], []
        for block, mine in _split(_block_of(order, layout.parts), layout.parts):
            parts.append(block)
            data.append(_blob(_steps(order[mine]), pos[mine]))
        return pa.Table.from_batches([_rows(parts, "anchors", data)])

    return run


def _anchors_of(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    order, pos = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for kind, x in zip(rows.column("kind").to_pylist(), rows.column("data")):
        if kind == "anchors":
            steps, where = _unblob(x.as_buffer().to_pybytes(), "<i8", "<u4")
            order.append(np.cumsum(steps))
            pos.append(where.astype(np.int64))
    return np.concatenate(order), np.concatenate(pos)


# -- 2: surroundings ----------------------------------------------------------------------------------------------


def _surroundings(layout: Layout):
    """What is around the candidates of a block, once for each different one, for each bucket of grams."""

    def run(packs: pa.Table, found: pa.Table) -> pa.Table:
        give_back()
        block = Block(packs)
        seen = block.surroundings(*_anchors_of(found), layout)
        lead = seen["lead"]
        parts, data = [], []
        number = packs.column("part")[0].as_py() if packs.num_rows else -1
        for bucket, own in _split((seen["gram"][lead] % np.uint64(layout.parts)).astype(np.int64), layout.parts):
            own = lead[own]
            left, right = seen["left"][own], seen["right"][own]
            head = _blob(seen["hash"][own], seen["order"][own], left.astype(np.uint8), right.astype(np.uint8))
            size = left + layout.gram + right
            begin = np.repeat(seen["place"][own] - left - (np.cumsum(size) - size), size)
            body = block.octets[begin + np.arange(size.sum())].tobytes()
            parts.append(bucket)
            data.append(b"".join([np.array([number, len(head), len(body)], "<i8").tobytes(), head,
                                  _codec().compress(body, asbytes=True)]))
        return pa.Table.from_batches([_rows(parts, "around", data)])

    return run


# -- 3: suffix sort -----------------------------------------------------------------------------------------------


class Suffixes:
    """Byte strings in one array, compared by prefix hashes."""

    def __init__(self, octets: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        self.octets = np.concatenate([octets, np.zeros(1, np.uint8)])
        self.sums = hashing.prefix(self.octets)
        self.inverse = hashing.powers(len(self.sums))[1]
        self.starts, self.sizes = starts, sizes

    def extension(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common beginning of strings i and j, by binary search over hashes."""
        x, y = self.starts[i], self.starts[j]
        low, high = np.zeros(len(x), np.int64), np.minimum(self.sizes[i], self.sizes[j])
        from_x, from_y, by_x, by_y = self.sums[x], self.sums[y], self.inverse[x], self.inverse[y]
        for _ in range(int(high.max(initial=0)).bit_length()):
            middle = (low + high + 1) >> 1
            equal = (self.sums[x + middle] - from_x) * by_x == (self.sums[y + middle] - from_y) * by_y
            low, high = np.where(equal, middle, low), np.where(equal, high, middle - 1)
            high = np.maximum(low, high)
        return low

    def before(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether string i sorts before string j: by the byte after the common beginning; an end comes first."""
        n = self.extension(i, j)
        end_i, end_j = n >= self.sizes[i], n >= self.sizes[j]
        byte = self.octets[self.starts[i] + n * ~end_i] < self.octets[self.starts[j] + n * ~end_j]
        return np.where(end_i | end_j, end_i & ~end_j, byte)

    def sort(self, groups: np.ndarray) -> np.ndarray:
        """Mergesort inside each group (``groups`` ascending); all merges of one level are done together.

        An element's place in the merged run is its own rank plus the number
        of elements of the neighbouring run before it, found by binary search.
        """
        n = len(groups)
        order = np.arange(n)
        first = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]])) if n else order
        sizes = np.diff(np.append(first, n))
        base, size = np.repeat(first, sizes), np.repeat(sizes, sizes)
        run = 1
        live = np.flatnonzero(size > run)
        while len(live):
            rank = live - base[live]
            own = rank // run
            other = (own ^ 1) * run
            low = base[live] + np.minimum(other, size[live])
            high = base[live] + np.minimum(other + run, size[live])
            begin, is_right = low.copy(), (own & 1).astype(bool)
            mine = order[live]
            open_ = np.flatnonzero(low < high)
            while len(open_):
                middle = (low[open_] + high[open_]) >> 1
                theirs, me = order[middle], mine[open_]
                # Equal strings keep their order: the left run's come first.
                ahead = np.where(is_right[open_], ~self.before(me, theirs), self.before(theirs, me))
                low[open_] = np.where(ahead, middle + 1, low[open_])
                high[open_] = np.where(ahead, high[open_], middle)
                open_ = open_[low[open_] < high[open_]]
            pair = base[live] + (own // 2) * 2 * run
            merged = order.copy()
            merged[pair + rank % run + (low - begin)] = mine
            order = merged
            run *= 2
            live = live[size[live] > run]
        return order


def _runs(rows: np.ndarray, sizes: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order of the strings of each group, and the verified common beginning of each with the one before it.

    ``rows``: strings padded with zeros. The order must be that of the bytes,
    or a hash has collided; it is then made from the bytes.
    """
    step = np.arange(rows.shape[1])
    known = step < sizes[:, None]
    suffixes = Suffixes(rows[known], np.cumsum(sizes) - sizes, sizes)
    order = suffixes.sort(groups)

    def neighbours(order):
        upper, lower = order[:-1], order[1:]
        same = (rows[upper] == rows[lower]) & known[upper] & known[lower]
        common = np.where(same.all(axis=1), rows.shape[1], (~same).argmax(axis=1))
        at = np.minimum(common, rows.shape[1] - 1)[:, None]
        ended = common >= sizes[upper]
        rising = ended | ((common < sizes[lower]) & (np.take_along_axis(rows[upper], at, 1) <
                                                      np.take_along_axis(rows[lower], at, 1))[:, 0])
        return common, rising | (groups[upper] != groups[lower])

    common, rising = neighbours(order)
    if not rising.all():
        # Group, bytes, then size: exact, whatever the hashes say.
        order = np.lexsort((sizes, *rows.T[::-1], groups))
        common, _ = neighbours(order)
    common = np.where(groups[order[1:]] == groups[order[:-1]], common, -1)
    return order, np.concatenate([[-1], common])


def first_documents(rows: np.ndarray, left: np.ndarray, right: np.ndarray, order: np.ndarray, groups: np.ndarray,
                    layout: Layout) -> np.ndarray:
    """(surroundings, bytes before the gram) -> first document that has this string of ``length`` bytes.

    LAST where the document ends too early. ``groups`` (ascending) hold the surroundings of one gram.
    """
    n, reach = len(rows), layout.reach
    forward, ahead = _runs(rows[:, reach:], layout.gram + right, groups)
    backward, behind = _runs(rows[:, :reach][:, ::-1], left, groups)
    out = np.full((n, reach + 1), LAST, np.int64)
    to_right, to_left = np.empty(n, np.int64), np.empty(n, np.int64)
    for before in range(reach + 1):
        # Runs of neighbours with long enough common beginnings are the classes of equal strings.
        to_right[forward] = np.cumsum(ahead < layout.length - before)
        to_left[backward] = np.cumsum(behind < before)
        has = np.flatnonzero((left >= before) & (right >= reach - before))
        if not len(has):
            continue
        key = to_right[has] * np.int64(n + 1) + to_left[has]
        own = np.argsort(key, kind="stable")
        starts = np.flatnonzero(np.concatenate([[True], key[own][1:] != key[own][:-1]]))
        low = np.minimum.reduceat(order[has][own], starts)
        out[has[own], before] = np.repeat(low, np.diff(np.append(starts, len(own))))
    return out


def _repeats(layout: Layout):
    """For each block: which strings around which surroundings an earlier document has."""

    def run(part: pa.Table) -> pa.Table:
        give_back()
        block, name, order, left, right, body = [], [], [], [], [], []
        for x in part.column("data"):
            data = x.as_buffer().to_pybytes()
            number, head, size = np.frombuffer(data, "<i8", 3).tolist()
            own = _unblob(data[24:24 + head], "<u8", "<i8", "u1", "u1")
            for into, values in zip((name, order, left, right), own):
                into.append(values)
            block.append(np.full(len(own[0]), number))
            body.append(pa.decompress(data[24 + head:], size, "zstd", asbytes=True))
        block, name, order = map(np.concatenate, (block, name, order))
        left, right = (np.concatenate(c).astype(np.int64) for c in (left, right))
        sizes = left + layout.gram + right
        places = np.cumsum(sizes) - sizes + left
        octets = np.frombuffer(b"".join(body), np.uint8)
        # The same surroundings in several blocks are sorted once, for their first document.
        _, lead, which = np.unique(name, return_index=True, return_inverse=True)
        # Different surroundings under one name in different blocks are sorted each for itself.
        other = _differing(octets, places, left, right, lead[which], layout)
        which[other] = len(lead) + np.arange(len(other))
        lead = np.concatenate([lead, other])
        low = np.full(len(lead), LAST, np.int64)
        np.minimum.at(low, which, order)
        gram = hashing.substrings(hashing.prefix(octets), places[lead], places[lead] + layout.gram)
        sequence = np.argsort(gram, kind="stable")
        lead, low, gram = lead[sequence], low[sequence], gram[sequence]
        back = np.empty(len(sequence), np.int64)
        back[sequence] = np.arange(len(sequence))
        which = back[which]
        windows = _window(octets, places[lead], left[lead], right[lead], layout)
        first = first_documents(windows, left[lead], right[lead], low, gram, layout)
        mask = np.zeros(len(name), np.uint64)
        for before in range(layout.reach + 1):
            mask |= (first[which, before] < order).astype(np.uint64) << np.uint64(before)
        some = np.flatnonzero(mask)
        parts, data = [], []
        for number in np.unique(block[some]):
            own = some[block[some] == number]
            parts.append(int(number))
            data.append(_blob(name[own], mask[own]))
        return pa.Table.from_batches([_rows(parts, "repeats", data)])

    return run


# -- 4: cover -----------------------------------------------------------------------------------------------------


def _covered(block: Block, seen: dict[str, np.ndarray], names: np.ndarray, masks: np.ndarray, layout: Layout) -> np.ndarray:
    """Whether each byte of a block lies in a string that an earlier document has."""
    cover = np.zeros(len(block.octets) + 1, np.int64)
    if len(seen["place"]):
        every = np.uint64((1 << (layout.reach + 1)) - 1)
        known = dict(zip(names.tolist(), masks.tolist()))
        lead = seen["lead"]
        of_lead = np.array([known.get(h, 0) for h in seen["hash"][lead].tolist()], np.uint64)
        # A later document of the block has all strings of these surroundings from the first one.
        mask = np.where(seen["order"] > seen["order"][lead][seen["group"]], every, of_lead[seen["group"]])
        begins = []
        for before in range(layout.reach + 1):
            hit = (mask >> np.uint64(before) & np.uint64(1)).astype(bool)
            hit &= (seen["left"] >= before) & (seen["right"] >= layout.reach - before)
            begins.append(seen["place"][hit] - before)
        begin = np.concatenate(begins)
        cover = np.bincount(begin, minlength=len(cover)) - np.bincount(begin + layout.length, minlength=len(cover))
    return np.cumsum(cover)[:-1] > 0


def _cut(layout: Layout, names: list[str], text_col: str, schema: pa.Schema):
    def run(packs: pa.Table, found: pa.Table) -> pa.Table:
        give_back()
        block = Block(packs)
        if block.rows is None:
            return schema.empty_table()
        seen = block.surroundings(*_anchors_of(found), layout)
        repeats = found.filter(pa.compute.equal(found.column("kind"), "repeats"))
        covered = _covered(block, seen, *_joined(repeats.column("data"), "<u8", "<u8"), layout)
        kept, removed, spans = [], [], []
        for begin, end in zip(block.starts.tolist(), block.ends.tolist()):
            own = covered[begin:end]
            kept.append(block.octets[begin:end][~own].tobytes())
            edges = np.flatnonzero(np.diff(np.concatenate([[0], own.view(np.int8), [0]])))
            removed.append(int(own.sum()))
            spans.append(np.stack([edges[::2], edges[1::2]], axis=1).tolist())
        columns = {c: block.rows.column(c) for c in names if c != text_col}
        text = block.rows.column("octets").cast(pa.string())
        columns[text_col] = pa.compute.if_else(block.rows.column("absent"), pa.scalar(None, pa.string()), text)
        columns |= {"n_bytes": [len(t) for t in block.texts], "n_removed": removed, "removed": spans, "kept": kept,
                    "kept_sha256": [hashlib.sha256(k).hexdigest() for k in kept]}
        return pa.Table.from_pydict(columns, schema=schema)

    return run


def remove_repeats(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` with what is left of its text.

    A byte is removed if it lies in a string of ``length`` bytes that also
    starts in a document of smaller id, as both were given. Adds n_bytes,
    n_removed, removed (maximal runs as [begin, end)), kept (the other bytes)
    and kept_sha256; columns of these names, and of the names order, octets and
    absent, are left out. Null texts are
    empty. Documents of null id come after all others; documents of one id
    remove nothing from each other. ``length`` is at least 32.
    """
    if length < 32:
        raise ValueError("length is at least 32")
    added = ["n_bytes", "n_removed", "removed", "kept", "kept_sha256"]
    given = docs.drop(*added, "order", "octets", "absent")
    spark = docs.sparkSession
    total = given.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    layout = Layout(length, max(FEWEST, -(-total // BLOCK_BYTES)))
    read = given.withColumns({"order": F.coalesce(F.col(id_col).cast("long"), F.lit(int(LAST))),
                              "octets": binary_text(text_col), "absent": F.col(text_col).isNull()})
    narrow = read.select("order", "octets")
    found = stored(_anchor_rows(narrow, layout).groupBy("part").applyInArrow(_candidates(layout), PARTED), "anchors")
    around = _packs(narrow, layout).groupBy("part").cogroup(found.groupBy("part")).applyInArrow(
        _surroundings(layout), PARTED)
    repeats = around.groupBy("part").applyInArrow(_repeats(layout), PARTED)
    names = given.columns
    kind = T.StructType([*given.schema.fields, *T.StructType.fromDDL(
        "n_bytes long, n_removed long, removed array<array<long>>, kept binary, kept_sha256 string").fields])
    schema = spark.createDataFrame([], kind).toArrow().schema
    marks = found.unionByName(repeats)
    return _packs(read.drop(text_col), layout).groupBy("part").cogroup(marks.groupBy("part")).applyInArrow(
        _cut(layout, names, text_col, schema), kind)
