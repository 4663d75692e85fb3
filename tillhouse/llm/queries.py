"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.llm import alignment, decontaminate, embeddings, langid, linededup, packing, quality, simhash, spelling, substrings, tokencount, toxicity, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def decontamination(spark: SparkSession, d: str) -> DataFrame:
    c = decontaminate.contamination(spark, _table(spark, d, "documents"), _table(spark, d, "benchmark"))
    return c.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def pack(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(spark, _table(spark, d, "documents"))


def line_dedup(spark: SparkSession, d: str) -> DataFrame:
    rows = linededup.dedup_lines(spark, _table(spark, d, "documents"))
    return rows.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"),
                       F.sha2(F.coalesce("__kept", F.lit("")), 256).alias("kept_sha256"))


def toxic(spark: SparkSession, d: str) -> DataFrame:
    rows = toxicity.toxicity(spark, _table(spark, d, "documents"), _table(spark, d, "labels"))
    return rows.select("doc_id", "held_out", "score", "predicted")


def quality_grades(spark: SparkSession, d: str) -> DataFrame:
    return quality.grade(spark, _table(spark, d, "documents"), _table(spark, d, "labels"))


def language(spark: SparkSession, d: str) -> DataFrame:
    return langid.identify(spark, _table(spark, d, "documents"))


def repeated_substrings(spark: SparkSession, d: str) -> DataFrame:
    return substrings.remove_repeats(spark, _table(spark, d, "documents"))


def archives(spark: SparkSession, d: str) -> DataFrame:
    rows = warc.archive_pages(spark, _table(spark, d, "pages"))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def near_vectors(spark: SparkSession, d: str) -> DataFrame:
    return embeddings.near_embeddings(spark, _table(spark, d, "embeddings"))


def near_copies(spark: SparkSession, d: str) -> DataFrame:
    g = simhash.simhash_groups(spark, _table(spark, d, "documents"))
    return g.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def spelling_groups(spark: SparkSession, d: str) -> DataFrame:
    return spelling.spelling_variants(spark, _table(spark, d, "documents"))


def aligned_tokens(spark: SparkSession, d: str) -> DataFrame:
    return alignment.align(spark, _table(spark, d, "documents"))


def counted_tokens(spark: SparkSession, d: str) -> DataFrame:
    return tokencount.token_counts(spark, _table(spark, d, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": decontamination,
    "op2_packing": pack,
    "op3_line_dedup": line_dedup,
    "op4_toxicity": toxic,
    "op5_suffix_array_dedup": repeated_substrings,
    "op6_warc": archives,
    "op7_language_id": language,
    "op8_quality_classifier": quality_grades,
    "op9_embedding_near_dedup": near_vectors,
    "op10_simhash_near_dedup": near_copies,
    "op11_spelling_variants": spelling_groups,
    "op12_cross_tokenizer_alignment": aligned_tokens,
    "op13_token_counts": counted_tokens,
}

ORACLES: dict[str, str] = {
    "op6_warc": """WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
r AS (SELECT payload_digest AS d, min(page_id) AS first_id, count(*) AS n FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN n > 1 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n > 1 AND page_id <> first_id THEN first_id END AS refers_to
FROM p LEFT JOIN r ON d = payload_digest AND payload_bytes >= 100""",
    "op9_embedding_near_dedup": """WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
u AS (
  SELECT vec_id, label, e FROM v
  WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (
  SELECT vec_id AS node, vec_id AS to_id FROM v
  UNION
  SELECT reach.node, pairs.b FROM reach JOIN pairs ON pairs.a = reach.to_id),
c AS (SELECT node, min(to_id) AS component_id FROM reach GROUP BY node),
n AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
SELECT v.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v JOIN c ON c.node = v.vec_id LEFT JOIN n ON n.a = v.vec_id""",
}
