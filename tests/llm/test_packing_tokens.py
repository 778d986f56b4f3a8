"""op6_packing counts the tokens of whole texts."""

from tokenizers import Tokenizer

from tenderlake.llm import encoding
from tenderlake.llm.queries import QUERIES


def test_lengths_are_tokens(spark, tmp_path):
    texts = ["a b c", "x9Q/" * 5000, "", None, "two  words\n", "語" * 300, "unbelievably tokenised"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    plain = Tokenizer.from_file(encoding.tokenizer_path())
    want = {i: len(plain.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(texts)}
    got = QUERIES["op6_packing"](spark, str(tmp_path)).collect()
    assert {r.doc_id: r.n_tokens for r in got} == want and want[1] > 1000
    assert all(r.n_tokens <= r.bucket_length for r in got)
