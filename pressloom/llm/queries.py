"""One query per operator over its whole tables, and the SQL of those it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    chat, decontaminate, language, mix, near, pii, products, quality, resample, substring, toxicity, urlrules, whiten,
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op3_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mix.mix_sources(_table(spark, folder, "documents"))


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    chain = quality.train(docs, _table(spark, folder, "labels"))
    return quality.judged(docs.select("doc_id", "text"), chain).select("doc_id", "verdict.*")


def op2_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op5_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near.near_duplicates(_table(spark, folder, "documents"))


def op10_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.personal_data(_table(spark, folder, "documents"))


def op1_identify_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.predicted(_table(spark, folder, "documents"))


def op6_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(urlrules.QUERY_RULES, urlrules.RULES_DDL)
    pages = _table(spark, folder, "pages").select("page_id", "url")
    return urlrules.judged(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op7_format_chat(spark: SparkSession, folder: str) -> DataFrame:
    return chat.digests(chat.with_probe(_table(spark, folder, "conversations")))


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.scored(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op9_remove_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return substring.without_repeats(_table(spark, folder, "documents")).drop("kept_text")


def op11_top_products(spark: SparkSession, folder: str) -> DataFrame:
    return products.top_products(_table(spark, folder, "embeddings"))


def op12_whiten_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return whiten.whitened(_table(spark, folder, "embeddings"))


def op13_resample_to_target(spark: SparkSession, folder: str) -> DataFrame:
    return resample.resampled(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_identify_language": op1_identify_language,
    "op2_decontaminate": op2_decontaminate,
    "op3_mix_sources": op3_mix_sources,
    "op4_quality_rules": op4_quality_rules,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_url_rules": op6_url_rules,
    "op7_format_chat": op7_format_chat,
    "op8_toxicity": op8_toxicity,
    "op9_remove_repeats": op9_remove_repeats,
    "op10_personal_data": op10_personal_data,
    "op11_top_products": op11_top_products,
    "op12_whiten_embeddings": op12_whiten_embeddings,
    "op13_resample_to_target": op13_resample_to_target,
}

SUBSTRING_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM documents WHERE text IS NOT NULL),
starts AS (SELECT doc_id, i, array_to_string(ws[i:i + 49], ' ') AS win
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50)),
least_doc AS (SELECT win, min(doc_id) AS d FROM starts GROUP BY win),
hits AS (SELECT DISTINCT s.doc_id, s.i FROM starts s JOIN least_doc l ON s.win = l.win AND l.d < s.doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS k FROM hits),
per AS (SELECT doc_id, list(k) AS ks FROM gone GROUP BY doc_id),
kept AS (
  SELECT d.doc_id, coalesce(len(w.ws), 0) AS n_words, coalesce(len(p.ks), 0) AS n_removed,
         list_filter(coalesce(w.ws, []::VARCHAR[]), lambda x, k: p.ks IS NULL OR NOT list_contains(p.ks, k)) AS ks
  FROM documents d LEFT JOIN w USING (doc_id) LEFT JOIN per p USING (doc_id))
SELECT doc_id, n_words::BIGINT AS n_words, n_removed::BIGINT AS n_removed,
       sha256(array_to_string(ks, ' ')) AS kept_sha256 FROM kept
"""

ORACLE: dict[str, str] = {
    "op3_mix_sources": mix.SQL,
    "op6_url_rules": urlrules.SQL,
    "op7_format_chat": chat.SQL,
    "op9_remove_repeats": SUBSTRING_SQL,
    "op11_top_products": products.SQL,
    "op13_resample_to_target": resample.SQL,
}
