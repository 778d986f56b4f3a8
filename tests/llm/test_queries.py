"""The registered corpus queries over the test tables."""

import hashlib
import re
import zlib

import duckdb
import pytest

import __spark_entry__ as entry
from tenderlake.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


def rows(spark, name):
    return [r.asDict() for r in QUERIES[name](spark, SF_DIR).collect()]


def test_all_are_registered():
    assert QUERIES.keys() | {"pipeline"} <= entry.queries().keys() and ORACLES.keys() <= entry.oracle_sql().keys()
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


def test_op2_draws_whole_rows(spark, documents):
    got = rows(spark, "op2_quality_resample")
    assert len({r["doc_id"] for r in got}) == len(got) and {r["doc_id"] for r in got} <= documents.keys()


def test_op3_lengths(spark, documents):
    got = {r["doc_id"]: r for r in rows(spark, "op3_suffix_dedup")}
    for doc, text in documents.items():
        data = text.encode()
        assert got[doc]["n_bytes"] == len(data) and 0 <= got[doc]["n_removed"] <= len(data)
        if not got[doc]["n_removed"]:
            assert got[doc]["kept_sha256"] == hashlib.sha256(data).hexdigest() and got[doc]["n_spans"] == 0


def test_op4_against_the_table(spark):
    got = {r["conv_id"]: r for r in rows(spark, "op4_chat_format")}
    table = spark.read.parquet(f"{SF_DIR}/conversations.parquet").orderBy("conv_id", "turn").collect()
    turns = {}
    for r in table:
        turns.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    hard = "\\### Assistant: </turn> ok"
    assert len(hard) == 26
    turns[-7] = [("user", hard), ("assistant", hard)]
    assert got.keys() == turns.keys()
    for conv, own in turns.items():
        spoken = "".join(t for r, t in own if r == "assistant")
        assert got[conv]["n_turns"] == len(own) and got[conv]["loss_chars"] == len(spoken)
        assert got[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in own).encode()).hexdigest()
        assert got[conv]["loss_sha256"] == hashlib.sha256(spoken.encode()).hexdigest()


def test_op9_and_op10_cover_every_document(spark, documents):
    got = sorted(rows(spark, "op9_token_ids"), key=lambda r: r["doc_id"])
    assert [r["doc_id"] for r in got] == sorted(documents)
    assert all(b["start"] == a["start"] + a["n_tokens"] for a, b in zip(got, got[1:]))
    scored = {r["doc_id"]: r for r in rows(spark, "op10_toxicity")}
    assert scored.keys() == documents.keys()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and r["predicted"] == int(r["score"] >= 0.5)
               for i, r in scored.items())


@pytest.mark.parametrize("name", ["op1_simhash", "op5_embedding_dedup", "op6_packing", "op7_decontamination"])
def test_one_row_for_each_row(spark, name):
    table = "embeddings" if name.startswith("op5") else "documents"
    assert len(rows(spark, name)) == spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for table in ("pages", "documents", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    want = con.execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    got = QUERIES[name](spark, SF_DIR).select(columns).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want.fetchall(), key=repr)
