import random
from datetime import datetime, timedelta

import pytest

from tenderlake.llm import revisits

KIND = "record_id long, record_type string, url string, date timestamp, headers string, payload string, outcome string"
DAY = datetime(2024, 1, 1)


def brute(rows):
    out = {}
    for i, kind, url, date, headers, payload, _ in rows:
        fields = [(h.partition(":")[0].lower(), h.partition(":")[2].strip()) for h in (headers or "").split("\r\n") if ":" in h]
        out[i] = dict(kind=kind, url=url, date=date, fields=fields, payload=payload)
    tag = lambda f: next((v.removeprefix("W/") for n, v in f if n == "etag"), None)
    got = {}
    for i, r in out.items():
        if r["kind"] == "response":
            got[i] = ("full", i, r["fields"], r["payload"])
            continue
        known = [(q["date"], j) for j, q in out.items() if q["kind"] == "response" and q["url"] == r["url"] and
                 r["url"] is not None and None not in (q["date"], r["date"]) and q["date"] < r["date"]]
        if not known:
            got[i] = ("unmatched", None, r["fields"], r["payload"])
            continue
        j = max(known)[1]
        source, mine = out[j], tag(r["fields"])
        outcome = "unvalidated" if mine is None else "resolved" if mine == tag(source["fields"]) else "changed"
        update = [f for f in r["fields"] if f[0] in revisits.PERMITTED]
        kept = [f for f in source["fields"] if f[0] not in {n for n, _ in update}]
        got[i] = (outcome, j, kept + update, source["payload"]) if outcome == "resolved" else (outcome, j, r["fields"], r["payload"])
    return got


def test_against_brute_force(spark):
    rng = random.Random(8)
    rows = []
    for i in range(600):
        url = "a.org/hot" if rng.random() < 0.5 else rng.choice(["a.org/x", "b.org/y?q=1", None])
        date = None if rng.random() < 0.02 else DAY + timedelta(minutes=rng.randrange(300))
        etag = rng.choice(['ETag: "1"', 'ETag: "2"', 'etag: W/"1"', "X: y"])
        if rng.random() < 0.4:
            rows.append((i, "response", url, date, f"HTTP/1.1 200 OK\r\n{etag}\r\nServer: s\r\nSet-Cookie: a\r\nSet-Cookie: b:c\r\n"
                         "Cache-Control: old", f"p{i}", "x"))
        else:
            rows.append((i, "revisit", url, date, rng.choice([f"{etag}\r\nCache-Control: new\r\nContent-Length: 0", "", None]), None, "x"))
    df = spark.createDataFrame(rows, KIND).repartition(7)
    got = {r.record_id: (r.outcome, r.source_id, [tuple(f) for f in r.fields], r.payload) for r in revisits.resolve(df).collect()}
    assert got == brute(rows)
    assert {"resolved", "changed", "unvalidated", "unmatched", "full"} == {g[0] for g in got.values()}


@pytest.mark.parametrize("url,want", [
    ("HTTPS://WWW.Example.org:443/A/b//?b=2&utm_source=x&a=1#top", "example.org/A/b?a=1&b=2"),
    ("http://example.org", "example.org"), ("http://example.org/?utm_x=1", "example.org"), ("no scheme", "no scheme"),
    ("", ""), (None, None)])
def test_canonical_url(spark, url, want):
    assert spark.createDataFrame([(url,)], "url string").select(revisits.canonical_url("url").alias("u")).first().u == want


def test_last_modified_repeats_and_empty(spark):
    assert revisits.resolve(spark.createDataFrame([], KIND)).collect() == []
    rows = [(1, "response", "u", DAY, "Last-Modified: m", "p", ""), (2, "revisit", "u", DAY + timedelta(1), "Last-Modified: m", None, ""),
            (2, "revisit", "u", DAY + timedelta(1), "Last-Modified: m", None, ""), (3, "metadata", "u", DAY, "", "", "")]
    got = revisits.resolve(spark.createDataFrame(rows, KIND)).collect()
    assert sorted((r.record_id, r.outcome, r.source_id, r.payload) for r in got) == [
        (1, "full", 1, "p"), (2, "resolved", 1, "p"), (2, "resolved", 1, "p")]
