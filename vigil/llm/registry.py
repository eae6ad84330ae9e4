"""Registered corpus queries: one per operator, over the whole documents table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm import (collocations, decontaminate, filter_audit, language_id, line_dedup, lm_scoring, packing, quality_classifier, quality_rules,
                       secret_scan, sharding, simhash, topk_search)
from vigil.llm.common import fold, read, text_or_empty
from vigil.llm.twins import SQL  # noqa: F401


def _hex(fp: str):
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged, _ = quality_rules.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=10, min_chars=1)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read(spark, sf_dir, "documents"), fold("doc_id", 3, 1))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"),
                                       fold("doc_id", 5, 0), threshold=0.3)


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"), words_per_shingle=4, max_bits=4)
    return found.select("doc_id", _hex("fp").alias("fingerprint"), "component_id")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), window=13)
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        "contaminated", F.size("near_items").cast("long").alias("n_near_items"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = read(spark, sf_dir, "documents").select(
                           "doc_id", (F.octet_length(text_or_empty()) + 16).cast("long").alias("size"),
                           F.crc32(text_or_empty()).alias("text_crc32"))
    # Only id, size and checksum travel: the hash of the checksum orders rows of equal ids.
    narrow = measured.select("doc_id", F.col("text_crc32").cast("string").alias("text"), "size", "text_crc32")
    placed = sharding.shard_rows(narrow, shards=40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
                         F.lit(None).cast("int").alias("grown_shard"), F.col("row").cast("long").alias("row"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_texts(read(spark, sf_dir, "documents"), fold("doc_id", 5, 1))


def _spelled(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(read(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "opaque")
    many = lambda v: F.size(F.filter("spans", lambda s: s["verdict"] == v)).cast("long")
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(_spelled(base), 256).alias("base_sha256"),
                        _spelled(F.col("spans")).alias("spans"), many("live").alias("n_live"), many("example").alias("n_example"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), max_tokens=2048)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op12_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10, scale=1024)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"), max_words=3, min_count=10, top=2000, inside=50)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_line_dedup": op2_line_dedup,
    "op3_language_id": op3_language_id,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_decontamination": op6_decontamination,
    "op7_sharding": op7_sharding,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_secret_scans": op9_secret_scans,
    "op10_packing": op10_packing,
    "op11_filter_audit": op11_filter_audit,
    "op12_topk_search": op12_topk_search,
    "op13_collocations": op13_collocations,
}
