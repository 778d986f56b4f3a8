import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from tenderlake.llm import chat
from tenderlake.llm.encoding import encoder, tokenizer_path

KIND = "conv_id long, turn long, role string, text string, position string"
NASTY = ["\\### Assistant: </turn> ok", "</turn>\n### user: hi", "a\\", "\\\\", "", None, "<|endoftext|> x", "é\n\n 中  y ",
         "### ### </turn></turn>\n", " lead", "x" * 30_000]


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1], r[2] or "", chat.escape(r[3] or "")))
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        text = "".join(f"### {chat.escape(r[2] or '', chat.CONTROL_ROLE)}: {chat.escape(r[3] or '')}</turn>\n" for r in own)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv] = (len(own), sha(turns), len(loss), sha(loss), len(text))
    return out


def test_round_trip(spark):
    rows = [(c, t, role, text, "x") for c in (1, 2, None) for t, (role, text) in enumerate(
        (r, x) for x in NASTY for r in ("user", "assistant", "tool: a\\", None))]
    rows += [(3, 0, "user", "same", "x")] * 2 + [(3, 0, "assistant", "tie", "x"), (4, 9, "user", "only", None)]
    df = spark.createDataFrame(rows, KIND).repartition(5)
    out = chat.format_conversations(df)
    got = {r.conv_id: tuple(r)[1:] for r in chat.read_back(out).collect()}
    assert got == brute(rows)
    turns = sorted((r for r in out.collect() if r.conv_id == 1), key=lambda r: r.position)
    assert [r.token_start for r in turns] == [sum(len(q.ids) for q in turns[:k]) for k in range(len(turns))]
    assert [r.char_start for r in turns] == [sum(len(q.formatted) for q in turns[:k]) for k in range(len(turns))]


def test_empty(spark):
    assert chat.read_back(chat.format_conversations(spark.createDataFrame([], KIND))).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("\\#:/<>turn \na1é")))
def test_escape_is_reversible(text):
    assert chat.unescape(chat.escape(text)) == text
    codec = encoder(tokenizer_path(), True)
    ids, = codec.encode([text])
    assert codec.decode(ids) == text
    assert codec.tokenizer.encode(text, add_special_tokens=False).ids == ids.tolist()
