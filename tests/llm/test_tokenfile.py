import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tenderlake.llm import tokenfile
from tenderlake.llm.encoding import tokenizer_path


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 5000])
@pytest.mark.parametrize("top", [1, 2, 50_257, 2**32])
def test_blocks_round_trip(n, top):
    ids = np.random.default_rng(n).integers(0, max(top // 50, 1), n).astype(np.uint32)
    ids[::97] = top - 1
    shard = tokenfile.Shard(tokenfile.shard_bytes([None, 4], [n, 0], ids))
    assert np.array_equal(shard.tokens(), ids)
    assert np.array_equal(shard.tokens(300, 900), ids[300:900])
    assert shard.present.tolist() == [False, True]


def test_outliers_are_patched():
    ids = np.full(256, 5, np.uint32)
    ids[7] = 2**31
    assert len(tokenfile.pack(ids)[0]) == tokenfile.HEAD + 6


def test_matches_tokenizer(spark):
    rng = random.Random(1)
    words = ["the", "Ünder", "a,", "b.\nC", "", "x1", "don't", "\t", "<|endoftext|>", "lo-ng", "…"]
    texts = [" ".join(rng.choices(words, k=rng.choice([0, 1, 5, 80]))) for _ in range(120)] + [None, "", " x", "ab " * 9000]
    rows = [(i * 7 % 1000, t, "n") for i, t in enumerate(texts)] + [(3_000_000_000, "last", "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string, tokens string").repartition(6)
    got = {r.id: r for r in tokenfile.token_ids(df, shard_tokens=500, with_ids=True).collect()}
    tok, before = Tokenizer.from_file(tokenizer_path()), 0
    for doc_id, text, _ in sorted(rows, key=lambda r: r[0]):
        ids = tok.encode(text or "", add_special_tokens=False).ids + [0]
        row = got.pop(doc_id)
        assert (row.start, row.tokens, row.ids) == (before, len(ids), ids)
        assert row.crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        before += len(ids)
    assert not got


def test_null_ids_repeats_and_empty(spark):
    kind = "doc_id long, text string"
    assert tokenfile.token_ids(spark.createDataFrame([], kind)).collect() == []
    got = tokenfile.token_ids(spark.createDataFrame([(5, "b"), (None, "n"), (5, "a a"), (5, "b")], kind)).collect()
    assert sorted((r.id or -1, r.start, r.tokens) for r in got) == [(-1, 0, 2), (5, 2, 3), (5, 5, 2), (5, 7, 2)]
