"""Token-level chat formatting.

A turn is START role SEP text END. Role and text are escaped and encoded by
themselves; the three marks are reserved ids behind the vocabulary, so no text
can produce them. As text they read ``### ``, ``: `` and ``</turn>`` with a
line break; a backslash goes before each of these strings, and before each
backslash, inside a role or text, which makes the text form reversible too.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake.llm.encoding import encoder, tokenizer_path

START, SEP, END = "### ", ": ", "</turn>\n"
#: Reserved ids of START, SEP and END, counted from the size of the vocabulary.
MARKS = 3
CONTROL = re.compile(r"\\|### |</turn>")
CONTROL_ROLE = re.compile(r"\\|### |</turn>|: ")
ESCAPED = re.compile(r"\\(.)", re.DOTALL)

TURNS = ("conv_id {kind}, turn long, position long, role string, formatted string, char_start long, "
         "ids array<int>, loss array<boolean>, token_start long")


def escape(text: str, pattern: re.Pattern = CONTROL) -> str:
    return pattern.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def _turn(codec, roles: list[str], texts: list[str], learn: frozenset[str]):
    """Text form, ids and loss mask of each turn."""
    start = codec.tokenizer.get_vocab_size()
    escaped = [(escape(r, CONTROL_ROLE), escape(t)) for r, t in zip(roles, texts)]
    # A space-led piece encodes by itself, but a text may start in any way: segments are encoded one by one.
    encoded = codec.encode([s for pair in escaped for s in pair])
    for k, (role, (role_text, text)) in enumerate(zip(roles, escaped)):
        head, body = encoded[2 * k], encoded[2 * k + 1]
        ids = np.concatenate([[start], head, [start + 1], body, [start + 2]]).astype(np.int32)
        # +1 where the loss starts and -1 where it ends; the running sum is the mask.
        edge = np.zeros(len(ids) + 1, np.int64)
        if role in learn:
            edge[len(head) + 2] += 1
            edge[len(ids) - 1] -= 1
        yield f"{START}{role_text}{SEP}{text}{END}", ids, np.cumsum(edge)[:-1] > 0


def format_conversations(turns: DataFrame, learn: tuple[str, ...] = ("assistant",),
                         tokenizer: str = "byte_bpe_50k.json") -> DataFrame:
    """One row for each turn, in order within its conversation.

    formatted, ids and loss are the turn's share of the conversation's text,
    tokens and loss mask; char_start and token_start are the sums of what
    stands before it, position its number from 0. Turns are encoded where they
    are read, then brought together by conversation and numbered in one
    streaming pass, which holds one turn at a time. Order: turn, role, text;
    null role and text count as empty, rows of null conv_id are one
    conversation. Other columns are left out.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, wanted = encoder(tokenizer_path(tokenizer), True), frozenset(learn)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                roles, texts = part.column(2).to_pylist(), part.column(3).to_pylist()
                formatted, ids, loss = zip(*_turn(codec, roles, texts, wanted))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), pa.array(formatted, pa.string()),
                     pa.array(ids, pa.list_(pa.int32())), pa.array(loss, pa.list_(pa.bool_()))],
                    ["conv_id", "turn", "role", "formatted", "ids", "loss"])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, tokens, chars, place = object(), 0, 0, 0
        for batch in batches:
            starts = [[], [], []]
            sizes = zip(batch.column("conv_id").to_pylist(), batch.column("n_ids").to_pylist(),
                        batch.column("n_chars").to_pylist())
            for conv, n_ids, n_chars in sizes:
                if conv != now:
                    now, tokens, chars, place = conv, 0, 0, 0
                for into, value in zip(starts, (tokens, chars, place)):
                    into.append(value)
                tokens, chars, place = tokens + n_ids, chars + n_chars, place + 1
            token_start, char_start, position = (pa.array(x, pa.int64()) for x in starts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("turn"), position, batch.column("role"),
                 batch.column("formatted"), char_start, batch.column("ids"), batch.column("loss"), token_start],
                ["conv_id", "turn", "position", "role", "formatted", "char_start", "ids", "loss", "token_start"])

    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text"))
    encoded = rows.mapInArrow(encode, f"conv_id {kind}, turn long, role string, formatted string, "
                                      "ids array<int>, loss array<boolean>")
    sized = encoded.withColumns({"n_ids": F.size("ids"), "n_chars": F.char_length("formatted")})
    ordered = sized.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "formatted")
    return ordered.mapInArrow(number, TURNS.format(kind=kind))


def read_back(formatted: DataFrame, tokenizer: str = "byte_bpe_50k.json") -> DataFrame:
    """Digest of each conversation, from ids and loss mask alone.

    (conv_id, n_turns, turns_sha256 over "role, line break, text, line break"
    of each turn, loss_chars and loss_sha256 of all text under the mask,
    formatted_chars). Ids are cut at the reserved marks, decoded and unescaped.
    """
    kind = formatted.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoder(tokenizer_path(tokenizer), True)
        mark = codec.tokenizer.get_vocab_size()
        now, state, done = None, None, []
        for batch in batches:
            columns = zip(batch.column("conv_id").to_pylist(), batch.column("ids"), batch.column("loss"))
            for conv, ids, loss in columns:
                if state is None or conv != now:
                    if state is not None:
                        done.append(_digest(now, state))
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                _read_turn(codec, mark, ids.values.to_numpy(), loss.values.to_numpy(zero_copy_only=False), state)
            if done:
                yield _rows(done, names, batch.schema.field("conv_id").type)
                done = []
        if state is not None:
            yield _rows([_digest(now, state)], names, batch.schema.field("conv_id").type)

    ordered = formatted.select("conv_id", "position", "ids", "loss").repartition("conv_id").sortWithinPartitions(
        "conv_id", "position")
    return ordered.mapInArrow(run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, "
                                   "loss_sha256 string, formatted_chars long")


def _read_turn(codec, mark: int, ids: np.ndarray, loss: np.ndarray, state: list) -> None:
    sep = int(np.flatnonzero(ids == mark + 1)[0])
    if ids[0] != mark or ids[-1] != mark + 2:
        raise ValueError("a turn without its marks")
    role, text = codec.decode(ids[1:sep]), codec.decode(ids[sep + 1:-1])
    state[0] += 1
    state[1].update(f"{unescape(role)}\n{unescape(text)}\n".encode())
    edges = np.flatnonzero(np.diff(np.concatenate([[0], loss.astype(np.int8), [0]])))
    for begin, end in zip(edges[::2], edges[1::2]):
        learnt = unescape(codec.decode(ids[begin:end]))
        state[2] += len(learnt)
        state[3].update(learnt.encode())
    state[4] += len(START) + len(role) + len(SEP) + len(text) + len(END)


def _digest(conv, state: list) -> tuple:
    return conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]


def _rows(done: list[tuple], names: list[str], kind: pa.DataType) -> pa.RecordBatch:
    first, *rest = zip(*done)
    return pa.RecordBatch.from_arrays([pa.array(first, kind), *map(pa.array, rest)], names)
