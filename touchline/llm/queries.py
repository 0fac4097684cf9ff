"""One query per operator, over its whole table; the driver's entry module adds them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import (
    alignment, bpe, conversations, embeddings, fingerprints, licenses, packing, pii, quality, sharding, simhash, toxicity, warc,
)
from touchline.llm.common import table
from touchline.llm.words import held_out

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


#: Vocabularies of public tokenizers; the operators take their contents as a parameter.
RANKS, WORDS = "byte_bpe_50k.tiktoken", "word_bpe_49k.json"
BYTES, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op1_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.shard(table(spark, sf, "documents"), 24).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@_query
def op2_pii(spark: SparkSession, sf: str) -> DataFrame:
    return pii.personal_data(table(spark, sf, "documents"))


@_query
def op3_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    out = held_out(F.col("doc_id"), 5, 0)
    found = toxicity.score(docs, toxicity.train(docs, labels, ~out))
    return found.select("doc_id", out.alias("held_out"), "score", "predicted")


@_query
def op4_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints.compare_with_next(table(spark, sf, "documents"))


@_query
def op5_warc(spark: SparkSession, sf: str) -> DataFrame:
    merged = F.array_join(F.transform(F.map_entries("merged"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return warc.resolve(warc.records_of(table(spark, sf, "pages"))).select(
        "record_id", "kind", "canonical", F.col("at").cast("bigint").alias("fetched_at"), "status", "source_id",
        merged.alias("merged"),
    )


ORACLE["op5_warc"] = r"""
WITH page AS (
  SELECT page_id, url, '"' || md5(html) || '"' AS tag, CAST(strlen(html) AS VARCHAR) AS size, page_id * 600 + 1600000000 AS t FROM pages
), record AS (
  SELECT page_id * 4 + k AS record_id, k, CASE WHEN k = 0 THEN 'response' ELSE 'revisit' END AS kind, url, t + k * 3600 AS fetched_at,
    tag, size, strftime(make_timestamp(t * 1000000), '%Y-%m-%d %H:%M:%S') AS modified,
    strftime(make_timestamp((t + k * 3600) * 1000000), '%Y-%m-%d %H:%M:%S') AS date
  FROM page, (VALUES (0), (1), (2), (3)) AS v(k)
), bare AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '^[^/?@]*@', '') AS b FROM record
), named AS (
  SELECT *, regexp_replace(lower(regexp_extract(b, '^[^/?]*', 0)), ':(80|443)$|\.$', '')
      || regexp_replace(regexp_extract(b, '^[^/?]*([^?]*)', 1), '/+$', '') AS stem,
    array_to_string(list_sort(list_filter(string_split(regexp_extract(b, '\?(.*)$', 1), '&'),
      lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|gclid|fbclid|ref)(=|$)'))), '&') AS q
  FROM bare
), placed AS (
  SELECT *, stem || CASE WHEN q <> '' THEN '?' || q ELSE '' END AS canonical FROM named
), pair AS (
  SELECT a.record_id, r.record_id AS source_id, r.tag AS stored_tag, r.modified AS stored_modified, r.size AS stored_size, r.date AS stored_date,
    row_number() OVER (PARTITION BY a.record_id ORDER BY r.fetched_at DESC, r.record_id DESC) AS n
  FROM placed a JOIN placed r ON a.canonical = r.canonical AND r.fetched_at < a.fetched_at AND r.k = 0
  WHERE a.k > 0
), answer AS (
  SELECT p.*, m.source_id, m.stored_tag, m.stored_modified, m.stored_size,
    CASE WHEN p.k = 0 THEN 'full' WHEN m.source_id IS NULL THEN 'unmatched'
      WHEN p.k = 1 THEN CASE WHEN p.tag = m.stored_tag THEN 'resolved' ELSE 'changed' END
      WHEN p.k = 2 THEN 'changed'
      ELSE CASE WHEN p.modified = m.stored_modified THEN 'resolved' ELSE 'changed' END END AS status
  FROM placed p LEFT JOIN pair m ON p.record_id = m.record_id AND m.n = 1
)
SELECT record_id, kind, canonical, fetched_at, status,
  CASE WHEN k = 0 THEN record_id WHEN status = 'resolved' THEN source_id END AS source_id,
  CASE WHEN k = 0 THEN 'content-length=' || size || ';content-type=text/html;date=' || date || ';etag=' || tag || ';last-modified=' || modified
    WHEN status <> 'resolved' THEN NULL
    ELSE CASE WHEN k = 1 THEN 'cache-control=max-age=60;' ELSE '' END || 'content-length=' || stored_size
      || ';content-type=text/html;date=' || date || ';etag=' || stored_tag || ';last-modified=' || stored_modified END AS merged
FROM answer
"""


@_query
def op6_packing(spark: SparkSession, sf: str) -> DataFrame:
    definition = packing.read_definition(public_tokenizers.path(WORDS))
    return packing.pack(table(spark, sf, "documents"), definition)


@_query
def op7_simhash(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf, "documents"))
    return found.withColumn("fingerprint", F.lpad(F.lower(F.hex("fingerprint")), 16, "0"))


@_query
def op8_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    out = held_out(F.col("doc_id"), 3, 1)
    found = quality.score(docs, quality.train(docs, labels, ~out))
    return found.select("doc_id", out.alias("held_out"), "score", "predicted")


@_query
def op9_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf, "embeddings"))


ORACLE["op9_embeddings"] = """
WITH RECURSIVE vector AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), usable AS (
  SELECT vec_id, e FROM vector WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9
), reached AS (
  SELECT vec_id, vec_id AS other FROM vector UNION SELECT r.vec_id, l.b FROM reached r JOIN link l ON l.a = r.other
), least AS (
  SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id
)
SELECT v.vec_id, CAST(COALESCE(n, 0) AS BIGINT) AS n_links, component_id, v.vec_id = component_id AS kept
FROM vector v JOIN least USING (vec_id) LEFT JOIN (SELECT a, COUNT(*) AS n FROM link GROUP BY a) ON a = v.vec_id
"""


@_query
def op10_bpe(spark: SparkSession, sf: str) -> DataFrame:
    with open(public_tokenizers.path(RANKS), "rb") as file:
        ranks = file.read()
    return bpe.digests(table(spark, sf, "documents"), ranks, public_tokenizers.PATTERN)


@_query
def op11_licenses(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.licenses(table(spark, sf, "documents"))


@_query
def op12_conversations(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations")
    return conversations.digests(conversations.damaged(turns), turns)


@_query
def op13_alignment(spark: SparkSession, sf: str) -> DataFrame:
    definitions = alignment.read_definitions(public_tokenizers.path(BYTES), public_tokenizers.path(PIECES), public_tokenizers.PATTERN)
    return alignment.digests(table(spark, sf, "documents"), definitions)
