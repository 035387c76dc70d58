"""Registered queries of the training-data operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from barline.llm.bpe import encode_decode
from barline.llm.common import remainder, table
from barline.llm.compression import compression_rules
from barline.llm.decontaminate import find_leaks
from barline.llm.filter_audit import ORACLE as AUDIT_SQL, audit_filters
from barline.llm.jaccard import jaccard_classes
from barline.llm.licenses import scan_licenses
from barline.llm.lm import score_with_held_out
from barline.llm.main_text import extract_main_text
from barline.llm.manifest import manifest
from barline.llm.pii import find_pii, fit_span_model
from barline.llm.quality import THRESHOLD, fit_quality, score_quality
from barline.llm.sharding import ORACLE as SHARDING_SQL, assign_shards
from barline.llm.token_files import read_token_files, write_token_files

ORACLE: dict[str, str] = {"op5_sharding": SHARDING_SQL, "op11_filter_audit": AUDIT_SQL}


def op1_jaccard_join(spark, sf_dir):
    return jaccard_classes(table(spark, sf_dir, "documents"))


def op2_language_model(spark, sf_dir):
    return score_with_held_out(table(spark, sf_dir, "documents"), min_count=1).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op3_decontamination(spark, sf_dir):
    found = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op4_compression_bands(spark, sf_dir):
    return compression_rules(table(spark, sf_dir, "documents"))


def op5_sharding(spark, sf_dir):
    return assign_shards(table(spark, sf_dir, "documents"))


def op6_personal_data(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return find_pii(docs, fit_span_model(docs))


def op7_token_files(spark, sf_dir):
    url, manifest = write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"),
                                      end_id=2, lower=True)
    return read_token_files(spark, url, manifest)


def op8_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    scored = score_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op9_byte_bpe(spark, sf_dir):
    return encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                         public_tokenizers.PATTERN)


def op10_license_scan(spark, sf_dir):
    return scan_licenses(table(spark, sf_dir, "documents")).drop("detections")


def op11_filter_audit(spark, sf_dir):
    return audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_html_extraction(spark, sf_dir):
    return extract_main_text(table(spark, sf_dir, "pages"))


def op13_merkle_manifest(spark, sf_dir):
    n_chars, key = F.col("n_chars"), F.col("doc_id").cast("string")
    tampered = F.when(F.crc32(key.cast("binary")) % 7 == 0, n_chars + 1).otherwise(n_chars)
    proved = manifest(table(spark, sf_dir, "documents"), claims={"n_chars": tampered})
    return proved.drop("proof").withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES = {
    "op1_jaccard_join": op1_jaccard_join,
    "op2_language_model": op2_language_model,
    "op3_decontamination": op3_decontamination,
    "op4_compression_bands": op4_compression_bands,
    "op5_sharding": op5_sharding,
    "op6_personal_data": op6_personal_data,
    "op7_token_files": op7_token_files,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_license_scan": op10_license_scan,
    "op11_filter_audit": op11_filter_audit,
    "op12_html_extraction": op12_html_extraction,
    "op13_merkle_manifest": op13_merkle_manifest,
}
