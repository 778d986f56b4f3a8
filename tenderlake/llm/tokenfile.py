"""Token-id shards in patched frame-of-reference blocks.

A shard holds consecutive documents, ordered by id:

    magic (8 bytes) | tokens, documents, blocks, block size (4 x u64)
    document ids (i64 each) | id present (u8 each) | tokens of each document (u64 each)
    block starts inside the payload (u64 each, one more than blocks)
    payload: for each block  minimum u32 | width u8 | exceptions u16
             | values minus minimum, ``width`` bits each | exception places u16 each | exception values u32 each

The width of a block is the smallest that holds the chosen share of its
values; the others are exceptions, whose packed bits are zero. Numbers are
little-endian.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tenderlake.llm.common import stored, text_batches
from tenderlake.llm.encoding import encoder, tokenizer_path
from tenderlake.session import scratch_path

MAGIC = b"PFORTOK1"
BLOCK = 256
SHARE = 0.95
HEAD = 7
#: Bytes of text encoded together: many pieces come again.
ENCODED = 8 << 20


def pack(ids: np.ndarray, share: float = SHARE) -> tuple[bytes, np.ndarray]:
    """Payload of the blocks and their starts."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    if not blocks:
        return b"", np.zeros(1, np.uint64)
    padded = np.full(blocks * BLOCK, ids[-1], np.uint32)
    padded[:n] = ids
    values = padded.reshape(blocks, BLOCK)
    low = values.min(axis=1)
    values = values - low[:, None]
    needed = np.frexp(values.astype(np.float64))[1].astype(np.uint8)  # bits of each value
    width = np.sort(needed, axis=1)[:, int(np.ceil(share * BLOCK)) - 1]
    outside = needed > width[:, None]
    patches = outside.sum(axis=1)
    sizes = HEAD + width.astype(np.int64) * (BLOCK // 8) + 6 * patches
    starts = np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros(starts[-1], np.uint8)
    _put(out, starts[:-1], low.astype("<u4").view(np.uint8).reshape(-1, 4))
    _put(out, starts[:-1] + 4, width[:, None])
    _put(out, starts[:-1] + 5, patches.astype("<u2").view(np.uint8).reshape(-1, 2))
    inside = np.where(outside, 0, values).astype("<u4")
    for w in np.unique(width):
        if w:
            own = np.flatnonzero(width == w)
            for part in np.array_split(own, -(-len(own) // 1024)):
                bits = np.unpackbits(inside[part].view(np.uint8).reshape(len(part), BLOCK, 4), axis=2,
                                     bitorder="little")[:, :, :w]
                _put(out, starts[part] + HEAD, np.packbits(bits.reshape(len(part), -1), axis=1, bitorder="little"))
    row, place = np.nonzero(outside)
    rank = np.arange(len(row)) - np.repeat(np.cumsum(patches) - patches, patches)
    tail = starts[:-1] + HEAD + width.astype(np.int64) * (BLOCK // 8)
    _put(out, tail[row] + 2 * rank, place.astype("<u2").view(np.uint8).reshape(-1, 2))
    _put(out, (tail + 2 * patches)[row] + 4 * rank, values[row, place].astype("<u4").view(np.uint8).reshape(-1, 4))
    return out.tobytes(), starts.astype(np.uint64)


def _put(out: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    out[at[:, None] + np.arange(rows.shape[1])] = rows


def unpack(payload: np.ndarray, starts: np.ndarray, n: int, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids of the blocks first .. last - 1 (all by default) of a shard of ``n`` ids."""
    last = len(starts) - 1 if last is None else last
    at = starts[first:last].astype(np.int64)
    count = len(at)
    if not count:
        return np.empty(0, np.uint32)
    get = lambda where, size, kind: np.ascontiguousarray(payload[where[:, None] + np.arange(size)]).view(kind)[:, 0]
    low, width, patches = get(at, 4, "<u4"), payload[at + 4], get(at + 5, 2, "<u2").astype(np.int64)
    values = np.zeros((count, BLOCK), np.uint32)
    for w in np.unique(width):
        if w:
            own = np.flatnonzero(width == w)
            for part in np.array_split(own, -(-len(own) // 1024)):
                packed = payload[(at[part] + HEAD)[:, None] + np.arange(int(w) * BLOCK // 8)]
                bits = np.zeros((len(part), BLOCK, 32), np.uint8)
                bits[:, :, :w] = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(part), BLOCK, w)
                values[part] = np.packbits(bits, axis=2, bitorder="little").view("<u4")[:, :, 0]
    row = np.repeat(np.arange(count), patches)
    if len(row):
        rank = np.arange(len(row)) - np.repeat(np.cumsum(patches) - patches, patches)
        tail = at + HEAD + width.astype(np.int64) * (BLOCK // 8)
        place = get(tail[row] + 2 * rank, 2, "<u2")
        values[row, place] = get((tail + 2 * patches)[row] + 4 * rank, 4, "<u4")
    return (values + low[:, None]).ravel()[:n - first * BLOCK]


def shard_bytes(doc_ids: list[int | None], sizes: list[int], ids: np.ndarray) -> bytes:
    payload, starts = pack(ids)
    present = np.array([x is not None for x in doc_ids], np.uint8)
    known = np.array([0 if x is None else x for x in doc_ids], "<i8")
    head = np.array([len(ids), len(sizes), len(starts) - 1, BLOCK], "<u8")
    return b"".join([MAGIC, head.tobytes(), known.tobytes(), present.tobytes(), np.array(sizes, "<u8").tobytes(),
                     starts.astype("<u8").tobytes(), payload])


class Shard:
    """A shard read back; ``tokens(first, last)`` unpacks only the blocks it needs."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("no token shard")
        self.n, docs, blocks, block = np.frombuffer(data, "<u8", 4, 8).astype(np.int64).tolist()
        if block != BLOCK:
            raise ValueError(f"block size {block}")
        at = 40
        self.doc_ids = np.frombuffer(data, "<i8", docs, at)
        self.present = np.frombuffer(data, np.uint8, docs, at := at + 8 * docs).astype(bool)
        self.sizes = np.frombuffer(data, "<u8", docs, at := at + docs).astype(np.int64)
        self.starts = np.frombuffer(data, "<u8", blocks + 1, at := at + 8 * docs)
        self.payload = np.frombuffer(data, np.uint8, -1, at + 8 * (blocks + 1))

    def tokens(self, first: int = 0, last: int | None = None) -> np.ndarray:
        last = self.n if last is None else min(last, self.n)
        block = first // BLOCK
        found = unpack(self.payload, self.starts, self.n, block, -(-last // BLOCK))
        return found[first - block * BLOCK:last - block * BLOCK]


def write_shards(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text",
                 tokenizer: str = "byte_bpe_50k.json", end_id: int = 0, shard_tokens: int = 1 << 20) -> DataFrame:
    """Encode whole texts and write them as shards, in ascending order of id, into ``folder``.

    ``folder`` is a URI that every executor reaches. Documents are ranged by
    id, so shard names sort as their ids do. A shard is written under a name of
    its task attempt and renamed when complete: a repeated task replaces its
    own shard by the same bytes. Null texts are empty; every document gets
    ``end_id`` appended; rows with null id come first; rows of equal id are
    ordered by text. Returns (part, shard, name, docs, tokens) of the shards.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        store, top = pyarrow.fs.FileSystem.from_uri(folder)
        store.create_dir(top, recursive=True)
        codec = encoder(tokenizer_path(tokenizer))
        end, number = np.array([end_id], np.uint32), 0
        ids, sizes, tokens = [], [], []
        held = 0

        def flush() -> pa.RecordBatch:
            name = f"part-{task.partitionId():06d}-{number:06d}.pfor"
            draft = f"{top}/.{name}.{task.taskAttemptId()}"
            with store.open_output_stream(draft) as out:
                out.write(shard_bytes(ids, sizes, np.concatenate(tokens)))
            store.move(draft, f"{top}/{name}")
            return pa.RecordBatch.from_pydict({"part": [task.partitionId()], "shard": [number], "name": [name],
                                               "docs": [len(ids)], "tokens": [held]})

        for batch in text_batches(batches, ENCODED):
            for doc_id, found in zip(batch.column(0).to_pylist(), codec.encode(batch.column(1).fill_null(""))):
                ids.append(doc_id)
                sizes.append(len(found) + 1)
                tokens += [found, end]
                held += len(found) + 1
                if held >= shard_tokens:
                    yield flush()
                    ids, sizes, tokens, held, number = [], [], [], 0, number + 1
        if ids:
            yield flush()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.repartitionByRange("id").sortWithinPartitions("id", "text").mapInArrow(
        run, "part long, shard long, name string, docs long, tokens long")


def read_shards(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """(name, id, begin, tokens, crc32[, ids]) of each document; begin counts from the start of its shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                shard = Shard(content.as_buffer().to_pybytes())
                ids = shard.tokens().astype("<u4")
                stops = np.cumsum(shard.sizes)
                begins = stops - shard.sizes
                parts = [ids[i:j] for i, j in zip(begins.tolist(), stops.tolist())]
                columns = {"name": pa.array([path.rpartition("/")[2]] * len(parts)),
                           "id": pa.array(shard.doc_ids, mask=~shard.present), "begin": pa.array(begins),
                           "tokens": pa.array(shard.sizes),
                           "crc32": pa.array([zlib.crc32(p.tobytes()) for p in parts], pa.int64())}
                if with_ids:
                    columns["ids"] = pa.array([p.astype(np.int32) for p in parts], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(columns)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pfor").load(folder)
    return files.select("path", "content").mapInArrow(
        run, "name string, id long, begin long, tokens long, crc32 long" + ", ids array<int>" * with_ids)


def shard_starts(shards: DataFrame) -> DataFrame:
    """(name, before): ids in all shards before this one. Parts are summed first, so no task sees all shards."""
    parts = shards.groupBy("part").agg(F.sum("tokens").alias("part_tokens"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("part_tokens").over(order), F.lit(0)).alias("before_part"))
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.withColumn("inside", F.coalesce(F.sum("tokens").over(inside), F.lit(0))).join(parts, "part").select(
        "name", (F.col("before_part") + F.col("inside")).alias("before"))


def token_ids(docs: DataFrame, folder: str | None = None, with_ids: bool = False, **options) -> DataFrame:
    """Write ``docs`` as shards and read them back: (id, start, tokens, crc32[, ids]) of each document.

    start counts the ids of all documents before this one. An empty table
    writes no shard and gives no row.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "token-shards")
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"
    shards = stored(write_shards(docs, folder, **options), "shards")
    if shards.isEmpty():
        return spark.createDataFrame([], "id long, start long, tokens long, crc32 long" + ", ids array<int>" * with_ids)
    found = read_shards(spark, folder, with_ids).join(shard_starts(shards), "name")
    return found.withColumn("start", F.col("before") + F.col("begin")).drop("name", "begin", "before")
