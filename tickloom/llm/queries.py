"""The operators as registered queries over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import chat, periodic, repair, warc
from tickloom.llm.cross_polytope import similar_vectors
from tickloom.llm.packing import pack_documents
from tickloom.llm.pii import KINDS, find_pii, listed
from tickloom.llm.quality import GOOD_FROM, score_quality
from tickloom.llm.simhash import components
from tickloom.llm.suffix_dedup import remove_repeats
from tickloom.llm.syncmers import compare_edits
from tickloom.llm.toxicity import score_toxicity
from tickloom.llm.winnowing import contamination
from tickloom.sources.writers import scratch_path

TOKENIZER = "byte_bpe_50k.json"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


@query
def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = components(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op4_winnowing_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(ids.cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op9_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    path = scratch_path(spark, "warc")
    warc.write_warc(pages, path)
    records = warc.read_warc(spark, path)
    own = F.pandas_udf(lambda s: s.map(warc.digest), "string")
    whole = F.col("type") == "response"
    records = records.withColumn("size", F.when(whole, F.octet_length("payload").cast("long")).otherwise(F.col("http_length")))
    records = records.withColumn("read_digest", F.when(whole, own("payload")).otherwise(F.col("digest")))
    note = lambda x: F.col("metadata.fields")[x].cast(pages.schema["page_id"].dataType)
    return warc.transactions(records).select(
        note("page-id").alias("page_id"),
        F.col("size").alias("payload_bytes"),
        F.col("read_digest").alias("payload_digest"),
        F.col("type").alias("record_type"),
        note("first-page-id").alias("refers_to"),
    )


ORACLE_SQL["op9_warc_transactions"] = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), d AS (
  SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM p
), b AS (
  SELECT *, [('0x' || substr(h, 5 * i + 1, 5))::BIGINT FOR i IN range(8)] AS parts FROM d
)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((parts[(i // 4 + 1)::BIGINT] >> (15 - 5 * (i % 4))::BIGINT) & 31)::BIGINT + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM b
"""


@query
def op5_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_edits(table(spark, sf_dir, "documents"))


@query
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op10_semi_markov_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = find_pii(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return out.select(
        "doc_id",
        *(count(k) for k in KINDS),
        F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


@query
def op3_event_sourced_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    events = chat.as_events(rows.unionByName(extra.select([F.col(c).cast(t) for c, t in rows.select("conv_id", "turn", "role", "text").dtypes])))
    return chat.read_back(chat.conversations(events))


ORACLE_SQL["op3_event_sourced_chat"] = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), e AS (
  SELECT *, regexp_replace(replace(text, '\', '\\'), '<\|im_start\|>|<\|im_end\|>|<\|endoftext\|>|<\|im_sep\|>|</?s>|\[/?INST\]|<</?SYS>>', 'xx\0', 'g') AS body FROM c
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(role) + length(body) + 24) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "flagged")


@query
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", (F.col("score") >= GOOD_FROM).cast("int").alias("predicted"))


@query
def op11_cross_polytope_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_vectors(table(spark, sf_dir, "embeddings"))


ORACLE_SQL["op11_cross_polytope_near_dedup"] = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
), f AS (
  SELECT r, vec_id, e, len(e) AS d, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS m FROM v
  WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), l AS (
  SELECT a.r AS a, b.r AS b FROM f a JOIN f b ON a.d = b.d AND a.r <> b.r AND list_inner_product(a.e, b.e) / (a.m * b.m) >= 0.9
), c AS (
  SELECT r AS a, r AS b FROM v UNION SELECT c.a, l.b FROM c JOIN l ON c.b = l.a
), m AS (
  SELECT c.a AS r, min(v.vec_id) AS component_id FROM c JOIN v ON v.r = c.b GROUP BY c.a
)
SELECT v.vec_id, (SELECT count(*) FROM l WHERE l.a = v.r) AS n_links, m.component_id, v.vec_id IS NOT DISTINCT FROM m.component_id AS kept
FROM v JOIN m USING (r)
"""


@query
def op12_edit_lattice_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = repair.damaged(table(spark, sf_dir, "conversations"))
    return repair.repair_conversations(rows, F.col("present")).drop("repaired")


def _edit(x: str, cost: str, letter: str) -> str:
    """``x`` (9 digits of cost, then the audit) after one more edit."""
    return f"(lpad((substr({x}, 1, 9)::BIGINT + {cost})::VARCHAR, 9, '0') || substr({x}, 10) || '{letter}')"


def _step(*paths: str) -> str:
    return f"least({', '.join(paths)})"


def _when(test: str, path: str) -> str:
    return f"CASE WHEN {test} THEN {path} END"


# One row a conversation carries the least cost and audit of each state; each round reads one more row.
ORACLE_SQL["op12_edit_lattice_repair"] = f"""
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations
), h AS (
  SELECT *, xor(list_reduce([4294967295::BIGINT] || list_transform(range(1, length(name) + 1), lambda i: ascii(name[i])::BIGINT),
    lambda crc, b: list_reduce([xor(crc, b)] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 20 AS c FROM k
), d AS (
  SELECT conv_id, turn, CASE WHEN c = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN c = 1 THEN '' WHEN c = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM h, range(2) t(again) WHERE c <> 0 AND (again = 0 OR c = 3)
), o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM d
), b AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
      WHEN regexp_extract(text, '(?s).*([^\x20\x09-\x0D])', 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
    left(role, 1) AS r, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM o
), p AS (
  SELECT conv_id, 0::BIGINT AS i, '000000000' AS z, NULL::VARCHAR AS s, '000000005I' AS u, '000000010II' AS a FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, i, z, s, least(u, {_edit("a", "5", "I")}), least(a, {_edit("u", "5", "I")}) FROM (
    SELECT conv_id, i, z, s, least(u, {_edit("z", "5", "I")}, {_edit("s", "5", "I")}) AS u, a FROM (
      SELECT p.conv_id, b.i, {_edit("z", "2", "D")} AS z,
        {_step(_edit("s", "2", "D"), _when("fault IN (0, 3) AND r = 's'", _edit("z", "CASE fault WHEN 3 THEN 5 ELSE 0 END", "K")))} AS s,
        {_step(_edit("u", "2", "D"), *(_when("fault IN (0, 3)", _edit(x, "CASE fault WHEN 3 THEN 6 ELSE 1 END", "R")) for x in "zsa"), *(_when("fault IN (0, 3) AND r = 'u'", _edit(x, "CASE fault WHEN 3 THEN 5 ELSE 0 END", "K")) for x in "zsa"))} AS u,
        {_step(_edit("a", "2", "D"), _when("fault IN (0, 3)", _edit("u", "CASE fault WHEN 3 THEN 6 ELSE 1 END", "R")), _when("fault IN (0, 3) AND r = 'a'", _edit("u", "CASE fault WHEN 3 THEN 5 ELSE 0 END", "K")))} AS a
      FROM p JOIN b ON p.conv_id IS NOT DISTINCT FROM b.conv_id AND b.i = p.i + 1))
), e AS (
  SELECT conv_id, i AS n, least(z, a) AS best FROM p QUALIFY i = max(i) OVER (PARTITION BY conv_id)
), x AS (
  SELECT conv_id, j, substr(best, 9 + j, 1) AS edit, length(replace(substr(best, 10, j), 'I', '')) AS i, length(replace(substr(best, 10, j), 'D', '')) AS m
  FROM (SELECT conv_id, best, unnest(range(1, length(best) - 8)) AS j FROM e)
), y AS (
  SELECT x.*, b.role, b.text, max(CASE WHEN m = 1 AND edit = 'K' AND r = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY x.conv_id) AS lead
  FROM x LEFT JOIN b ON x.edit <> 'I' AND x.conv_id IS NOT DISTINCT FROM b.conv_id AND x.i = b.i
), w AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (m - lead) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY j) AS said
  FROM y WHERE edit <> 'D' GROUP BY conv_id
), g AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count_if(fault = 1)::BIGINT AS blank, count_if(fault = 2)::BIGINT AS duplicate,
    count_if(fault = 3)::BIGINT AS truncated, count_if(before || r NOT IN ('su', 'ua', 'au'))::BIGINT AS illegal FROM b GROUP BY conv_id
)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, substr(best, 1, 9)::BIGINT AS cost, substr(best, 10) AS audit, sha256(coalesce(said, '')) AS repaired_sha256
FROM e LEFT JOIN g ON e.conv_id IS NOT DISTINCT FROM g.conv_id LEFT JOIN w ON e.conv_id IS NOT DISTINCT FROM w.conv_id
"""


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = periodic.periodic_runs(table(spark, sf_dir, "documents"), periodic.with_planted_runs())
    best = periodic.longest_run(F.col("runs"))
    length = -best["length"]
    return out.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        length.alias("length"),
        best["period"].alias("period"),
        F.floor(1000 * length / best["period"]).alias("exponent_milli"),
        periodic.runs_digest(F.col("runs")).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
