"""The encoder against the plain tokenizer."""

import random

import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tenderlake.llm.encoding import PieceEncoder, tokenizer_path

FRAGMENTS = ["the", "Ünder", "a,", "b.\nC", "", "x1", "don't", "\t", "<|endoftext|>", "lo-ng", "…", " ", "  ", " ", " ", "\x1c",
             "\x85", "Ġ", "中文", "é", "ǰ", "×", "÷", "a'b", "ŉ", "\n\n", "#", "A(b", "12.5", "_x", "\r", "ſt", "İ", "\x0b", "word" * 40]


@pytest.mark.parametrize("as_text", [False, True])
def test_ids_and_lengths(as_text):
    draw = random.Random(3)
    texts = ["".join(draw.choice(FRAGMENTS) + draw.choice([" ", "", " "]) for _ in range(draw.choice([0, 1, 3, 9, 40])))
             for _ in range(3000)]
    plain = Tokenizer.from_file(tokenizer_path())
    plain.encode_special_tokens = as_text
    encoder = PieceEncoder(tokenizer_path(), as_text)
    encoder.WORDS = 500  # the cache starts anew many times
    for at in range(0, len(texts), 100):
        part = texts[at:at + 100]
        got = encoder.encode(part)
        assert [g.tolist() for g in got] == [x.ids for x in plain.encode_batch(part, add_special_tokens=False)]
        assert encoder.lengths(pa.array(part)).tolist() == [len(g) for g in got]
        assert len(encoder.words) <= 2000


def test_slices_and_none():
    encoder = PieceEncoder(tokenizer_path())
    texts = pa.array(["one two", "three four", " five  six", "seven"])
    want = [x.tolist() for x in encoder.encode(texts)]
    assert [x.tolist() for x in encoder.encode(texts.slice(1, 2))] == want[1:3]
    assert encoder.encode([]) == [] and encoder.lengths(pa.array([], pa.string())).tolist() == []
