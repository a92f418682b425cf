"""The operators as queries over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat.llm.bpe import encode_documents
from concordat.llm.conversations import repair_conversations
from concordat.llm.embed_dedup import near_embeddings
from concordat.llm.hard_negatives import hard_negatives
from concordat.llm.jaccard import jaccard_components
from concordat.llm.langid import predict_languages
from concordat.llm.packing import pack_documents
from concordat.llm.ppm import language_model_scores
from concordat.llm.quality import quality_rules
from concordat.llm.substring_dedup import duplicate_spans
from concordat.llm.token_files import token_files
from concordat.llm.top_k import exact_top_k
from concordat.llm.url_rules import filter_urls

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
#: Action, host and path of the stated rules.
URL_RULES = (
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"),
)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(_read(spark, sf_dir, "documents"), VOCABULARY)


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict_languages(_read(spark, sf_dir, "documents"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(_read(spark, sf_dir, "documents"), VOCABULARY, end_id=1)


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(_read(spark, sf_dir, "pages"), URL_RULES)


def op5_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_embeddings(_read(spark, sf_dir, "embeddings"), threshold=0.93)


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_read(spark, sf_dir, "documents"), percent=90, width=3)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_read(spark, sf_dir, "documents"), VOCABULARY, capacity=4096, end_id=2)


def op8_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_spans(_read(spark, sf_dir, "documents"), width=13).drop("spans")


def op9_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model_scores(_read(spark, sf_dir, "documents"), modulus=7, remainder=2)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_read(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(_read(spark, sf_dir, "conversations"))


def op13_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_language": op2_language,
    "op3_token_files": op3_token_files,
    "op4_url_rules": op4_url_rules,
    "op5_embeddings": op5_embeddings,
    "op6_jaccard": op6_jaccard,
    "op7_packing": op7_packing,
    "op8_substring": op8_substring,
    "op9_ppm": op9_ppm,
    "op10_quality": op10_quality,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_conversations": op12_conversations,
    "op13_top_k": op13_top_k,
}

_WHOLE = """
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
"""
_TOP_K = f"""
WITH v AS ({_WHOLE}),
pairs AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM pairs QUALIFY rank <= 5
"""
_HARD_NEGATIVES = f"""
WITH v AS (
  SELECT vec_id, q, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label FROM ({_WHOLE}) WHERE label IS NOT NULL),
pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
  n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 80 * p.positive_score <= 100 * n.score AND 100 * n.score <= 100 * p.positive_score
QUALIFY rank <= 5
"""


def _conversations_sql() -> str:
    """The edits by dynamic programming from the last row: what follows at best, by state of the grammar, and its lines."""

    def edit(cost: str, letter: str, after: str, line: str | None = None) -> str:
        lines = f"list_prepend({line}, {after}.o)" if line else f"{after}.o"
        return f"{{'c': {after}.c + {cost}, 'a': '{letter}' || {after}.a, 'o': {lines}}}"

    def least(*options: str) -> str:
        return f"list_sort([{', '.join(options)}])[1]"

    def row(state: int, keeps: dict[str, int], role: str, after: int) -> str:
        gone = edit("4", "D", f"f{state}")
        kept = " ".join(f"WHEN initial = '{i}' THEN " + edit("add", "K", f"f{to}", "role || ':' || text") for i, to in keeps.items())
        return f"""CASE WHEN fault IN (1, 2) THEN {gone} ELSE {least(
            gone, f"CASE {kept} ELSE {gone} END", edit("3 + add", "R", f"f{after}", f"'{role}:' || text"))} END AS b{state}"""

    user, assistant = "'user:'", "'assistant:'"
    both = edit("3", "I", edit("3", "I", "b3", assistant), user)
    ends = "{'c': 0, 'a': '', 'o': CAST([] AS VARCHAR[])}"
    dead = "{'c': 1000000000, 'a': '', 'o': CAST([] AS VARCHAR[])}"
    close = f"""{least("b0", edit("3", "I", "b2", user), both)} AS f0, {least("b1", edit("3", "I", "b2", user), both)} AS f1,
        {least("b2", edit("3", "I", "b3", assistant))} AS f2, {least("b3", edit("3", "I", "b2", user))} AS f3"""
    return f"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations),
hashed AS (
  SELECT *, xor(list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, len(k) + 1), lambda i: CAST(ascii(k[i]) AS BIGINT))),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]),
      lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v // 2, CAST(3988292384 AS BIGINT)) ELSE v // 2 END)), CAST(4294967295 AS BIGINT)) % 20 AS kind
  FROM keyed),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM hashed WHERE kind <> 0),
placed AS (
  SELECT *, row_number() OVER w AS place, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS time,
    lag(role[1]) OVER w || role[1] AS pair, role[1] AS initial, regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS trimmed
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
faults AS (
  SELECT *, CASE WHEN trimmed = '' THEN 1 WHEN time > 1 THEN 2 WHEN right(trimmed, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault FROM placed),
facts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv_id),
walk AS (
  SELECT conv_id, n AS place, {close} FROM (SELECT conv_id, n, {ends} AS b0, {dead} AS b1, {dead} AS b2, {ends} AS b3 FROM facts)
  UNION ALL
  SELECT conv_id, place - 1, {close} FROM (
    SELECT conv_id, place, {row(0, {"s": 1, "u": 2}, "user", 2)}, {row(1, {"u": 2}, "user", 2)},
      {row(2, {"a": 3}, "assistant", 3)}, {row(3, {"u": 2}, "user", 2)}
    FROM (SELECT walk.*, role, text, initial, fault, CASE WHEN fault = 3 THEN 3 ELSE 0 END AS add
      FROM walk JOIN faults ON faults.conv_id IS NOT DISTINCT FROM walk.conv_id AND faults.place = walk.place)))
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, CAST(coalesce(f0.c, 0) AS BIGINT) AS cost, coalesce(f0.a, '') AS audit,
  sha256(coalesce(array_to_string(f0.o, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN facts ON facts.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN walk ON walk.conv_id IS NOT DISTINCT FROM c.conv_id AND walk.place = 0
"""


#: SQL cannot express tokenising; queries without SQL are held against the library and brute force in the tests.
ORACLES: dict[str, str] = {"op11_hard_negatives": _HARD_NEGATIVES, "op12_conversations": _conversations_sql(), "op13_top_k": _TOP_K}
