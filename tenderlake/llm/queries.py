"""Registered queries of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.llm import (audit, chat, decontamination, embeddings, merkle, packing, private, quality, revisits, simhash,
                            suffixes, tokenfile, toxicity)
from tenderlake.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


@query("op1_simhash")
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp0"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


@query("op3_suffix_dedup")
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), length=50)
    return found.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), "kept_sha256")


@query("op4_chat_format")
def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    # One more conversation, whose texts hold control strings that are escaped already.
    hard = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"))
    return chat.read_back(chat.format_conversations(turns.unionByName(hard)))


@query("op9_token_ids")
def op9_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tokenfile.token_ids(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "start", F.col("tokens").alias("n_tokens"),
                        F.col("crc32").alias("ids_crc32"))


@query("op10_toxicity")
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.scores(docs, model).select(
        "doc_id", toxicity.held_out().alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


@query("op5_embedding_dedup")
def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept")


@query("op2_quality_resample")
def op2_quality_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows drawn; as many as target rows among the labelled ones."""
    return quality.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op6_packing")
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query("op7_decontamination")
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


#: Captures made from ``pages``: a full response of each page, and a later visit answered "not modified", by another
#: spelling of the URL. Some visits come too early, bring another tag, or none. Text that Spark and DuckDB both read.
CAPTURES = """
SELECT 2 * page_id AS record_id, 'response' AS record_type, url, 1700000000 + 60 * page_id AS seconds,
       concat('HTTP/1.1 200 OK', chr(10), 'ETag: "', substr(md5(html), 1, 12), '"', chr(10), 'Content-Type: text/html',
              chr(10), 'Cache-Control: max-age=', CAST(page_id % 100 AS string)) AS headers,
       html AS payload
FROM pages
UNION ALL
SELECT 2 * page_id + 1, 'revisit',
       CASE page_id % 4 WHEN 0 THEN url WHEN 1 THEN concat(url, '#part') WHEN 2 THEN replace(url, 'https://', 'HTTP://')
            ELSE concat(url, CASE WHEN url LIKE '%?%' THEN '&' ELSE '?' END, 'utm_medium=x') END,
       1700000000 + 60 * page_id + 86400 * (page_id % 3),
       concat('HTTP/1.1 304 Not Modified', chr(10),
              CASE WHEN page_id % 11 = 0 THEN '' WHEN page_id % 5 = 0 THEN concat('etag: "none"', chr(10))
                   ELSE concat('etag: W/"', substr(md5(html), 1, 12), '"', chr(10)) END,
              'Cache-Control: no-cache', chr(10), 'Content-Length: 0'),
       NULL
FROM pages"""

OP8_SQL = f"""
WITH captures AS ({CAPTURES}),
bare AS (SELECT *, regexp_replace(url, '#.*$', '') AS b FROM captures),
parts AS (SELECT *,
    regexp_replace(regexp_replace(lower(regexp_extract(b, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)', 1)), '^www\\.', ''),
                   ':(80|443)$', '') AS host,
    regexp_replace(regexp_extract(b, '^[^:]+://[^/?]*([^?]*)', 1), '/+$', '') AS path,
    list_sort(list_filter(string_split(regexp_extract(b, '\\?(.*)$', 1), '&'),
                          lambda p: p <> '' AND NOT starts_with(p, 'utm_'))) AS params FROM bare),
named AS (SELECT record_id, record_type, seconds, payload, headers,
    concat(host, path, CASE WHEN len(params) > 0 THEN concat('?', array_to_string(params, '&')) ELSE '' END) AS url,
    regexp_extract(headers, '[eE][tT]ag: (W/)?("[^"]*")', 2) AS tag,
    regexp_extract(headers, 'Cache-Control: ([^\n]*)', 1) AS cache,
    regexp_extract(headers, '[eE][tT]ag: ([^\n]*)', 1) AS given FROM parts),
paired AS (SELECT v.*, max(CASE WHEN r.seconds IS NULL THEN NULL ELSE (r.seconds, r.record_id) END) AS latest
    FROM named v LEFT JOIN named r ON r.record_type = 'response' AND r.url = v.url AND r.seconds < v.seconds
         AND v.record_type = 'revisit'
    GROUP BY ALL),
judged AS (SELECT p.*, s.record_id AS found, s.tag AS source_tag, s.payload AS source_payload,
    CASE WHEN p.record_type = 'response' THEN 'full' WHEN s.record_id IS NULL THEN 'unmatched'
         WHEN p.tag = '' THEN 'unvalidated' WHEN p.tag = s.tag THEN 'resolved' ELSE 'changed' END AS outcome
    FROM paired p LEFT JOIN named s ON s.record_id = p.latest[2] AND s.record_type = 'response')
SELECT record_id, record_type, url AS canonical_url, outcome,
       CASE WHEN outcome = 'full' THEN record_id ELSE found END AS source_id,
       CASE outcome WHEN 'full' THEN concat('etag=', given, ';content-type=text/html;cache-control=', cache)
            WHEN 'resolved' THEN concat('content-type=text/html;etag=', given, ';cache-control=', cache)
            ELSE concat(CASE WHEN given = '' THEN '' ELSE concat('etag=', given, ';') END, 'cache-control=', cache,
                        ';content-length=0') END AS fields,
       sha256(CASE outcome WHEN 'full' THEN payload WHEN 'resolved' THEN source_payload END) AS payload_sha256
FROM judged"""


@query("op8_revisits", OP8_SQL)
def op8_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = spark.sql(CAPTURES.replace("FROM pages", "FROM {pages}"), pages=table(spark, sf_dir, "pages"))
    records = captures.select("record_id", "record_type", "url", F.timestamp_seconds("seconds").alias("date"), "headers", "payload")
    found = revisits.resolve(records, carry=("payload",))
    fields = F.array_join(F.transform("fields", lambda h: F.concat(h["name"], F.lit("="), h["value"])), ";")
    return found.select("record_id", "record_type", "canonical_url", "outcome", "source_id", fields.alias("fields"),
                        F.sha2("payload", 256).alias("payload_sha256"))


OP11_SQL = r"""
WITH RECURSIVE docs AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body FROM documents),
split AS (SELECT *, list_filter(string_split_regex(body, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM docs),
known AS (SELECT doc_id, max(quality) FILTER (quality = 1) AS good, max(toxic) FILTER (toxic = 1) AS toxic
    FROM labels GROUP BY doc_id),
judged AS (SELECT s.part, coalesce(k.good, 0) AS good, coalesce(k.toxic, 0) AS toxic, concat(
    CASE WHEN len(words) < 200 THEN 'A' ELSE '' END,
    CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END,
    CASE WHEN 100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 2 * length(body) THEN 'C' ELSE '' END,
    CASE WHEN regexp_matches(body, '[#$%&*|]') THEN 'D' ELSE '' END,
    CASE WHEN s.doc_id > min(s.doc_id) OVER (PARTITION BY body) THEN 'E' ELSE '' END) AS fails
    FROM split s LEFT JOIN known k ON k.doc_id = s.doc_id),
sets AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM judged GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter),
orders AS (SELECT letter AS name FROM letters UNION ALL
    SELECT concat(o.name, l.letter) FROM orders o JOIN letters l ON NOT contains(o.name, l.letter)),
places AS (SELECT name AS filter_order, step, substr(name, step, 1) AS letter, substr(name, 1, step - 1) AS before
    FROM orders, unnest([1, 2, 3, 4, 5]) AS s(step) WHERE length(name) = 5),
counted AS (SELECT s.part, p.filter_order, p.step, p.letter,
    sum(CASE WHEN regexp_matches(fails, concat('[', p.before, p.letter, ']')) THEN 0 ELSE n END) AS kept,
    sum(CASE WHEN contains(fails, p.letter) AND translate(fails, p.before, '') = fails THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN contains(fails, p.letter) AND translate(fails, p.before, '') <> fails THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails = p.letter THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN contains(fails, p.letter) AND translate(fails, p.before, '') = fails THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN contains(fails, p.letter) AND translate(fails, p.before, '') = fails THEN toxic ELSE 0 END) AS toxic_lost
    FROM sets s, places p GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, letter) AS shapley
FROM counted"""


@query("op11_filter_audit", OP11_SQL)
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("filter")


@query("op12_personal_data")
def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_email to n_phone and base_sha256 tell of the patterns' spans; spans holds those of the field too."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = private.personal_data(docs, private.fit(docs))
    rank = lambda s: F.array_position(F.array(*map(F.lit, private.KINDS)), s["kind"])
    every = F.array_sort(F.transform(F.concat("base", "added"), lambda s: F.struct(
        rank(s).alias("rank"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    joined = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    kinds = F.col("base")["kind"]
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in private.KINDS]
    return found.select(F.col("id").alias("doc_id"), *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                        joined(every).alias("spans"))


def merkle_sql(levels: int = 11, trees: int = 4) -> str:
    """The manifest for groups of up to ``8 ** levels`` rows and up to ``8 ** trees`` groups, level by level."""
    crc = ("list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(strlen(d)), lambda i: "
           "list_concat([ord(substr(d, i + 1, 1))::BIGINT + 1000], list_transform(range(8), lambda j: -1::BIGINT))))), "
           "lambda c, x: CASE WHEN x >= 0 THEN xor(c, x - 1000) "
           "WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)")
    value = "CASE WHEN {0} IS NULL THEN '-' ELSE concat(strlen(CAST({0} AS VARCHAR)), ':', {0}) END"
    head = ", ".join(value.format(c) for c in ("doc_id", "source", "lang", "n_chars"))
    small = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [f"named AS (SELECT *, CAST(doc_id AS VARCHAR) AS d FROM documents)",
             f"""leaves AS MATERIALIZED (SELECT doc_id, lang AS g, sha256(concat({head}, {value.format('text')})) AS leaf,
                 CASE WHEN xor({crc}, 4294967295) % 3 = 0 THEN sha256(concat({head}, {value.format(small)})) END AS tampered
                 FROM named)""",
             """l0 AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
                 leaf AS node, count(*) OVER (PARTITION BY g) AS total FROM leaves)"""]

    def climb(prefix: str, count: int) -> None:
        for k in range(count):
            parts.append(f"""{prefix}s{k} AS MATERIALIZED (SELECT g, pos, node, total,
                CASE WHEN total > 1 THEN coalesce(string_agg(node, '') OVER (PARTITION BY g, pos // 8 ORDER BY pos
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') ELSE '' END AS lft,
                CASE WHEN total > 1 THEN coalesce(string_agg(node, '') OVER (PARTITION BY g, pos // 8 ORDER BY pos
                    ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') ELSE '' END AS rgt FROM {prefix}{k})""")
            parts.append(f"""{prefix}{k + 1} AS MATERIALIZED (SELECT g, pos // 8 AS pos, (total + 7) // 8 AS total,
                CASE WHEN total = 1 THEN min(node) ELSE sha256(string_agg(node, '' ORDER BY pos)) END AS node
                FROM {prefix}{k} GROUP BY g, pos // 8, total)""")

    climb("l", levels)
    parts.append(f"""t0 AS MATERIALIZED (SELECT g AS name, 0 AS g, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS pos,
        count(*) OVER () AS total, node FROM l{levels})""")
    climb("t", trees)
    parts.append(f"""f0 AS (SELECT l.doc_id, l.leaf, l.g, l.pos, t.node AS subroot, t.pos AS tree, r.node AS root,
        '' AS proof, coalesce(l.tampered, l.leaf) AS fold
        FROM l0 l JOIN t0 t ON t.name IS NOT DISTINCT FROM l.g CROSS JOIN t{trees} r)""")
    for k in range(levels + trees):
        of, n, at = ("l", k, "pos") if k < levels else ("t", k - levels, "tree")
        same = "s.g IS NOT DISTINCT FROM f.g AND " if of == "l" else ""
        parts.append(f"""f{k + 1} AS (SELECT f.* REPLACE (concat(proof, lft, rgt) AS proof,
            CASE WHEN s.total = 1 THEN fold ELSE sha256(concat(lft, fold, rgt)) END AS fold)
            FROM f{k} f JOIN {of}s{n} s ON {same}s.pos = f.{at} // {8 ** n})""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = root AS verified
FROM f{levels + trees}"""


@query("op13_merkle_manifest", merkle_sql())
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.check_tampering(table(spark, sf_dir, "documents"))
