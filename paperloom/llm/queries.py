"""Registered queries of these operators and, where SQL can express them, their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from paperloom.llm import (
    bpe, byte_bpe, decontaminate, langid, licenses, oracle, periodic, quality, secret_scan, simhash, substring, topk, warc, whitening,
)
from paperloom.llm.tables import table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_quality_classifier(spark, sf_dir):
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_secret_scan(spark, sf_dir):
    return secret_scan.scan_documents(table(spark, sf_dir, "documents"))


def op3_exact_top_k(spark, sf_dir):
    vectors = topk.quantise(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors.where(F.col("vec_id") % 20 == 0), vectors)


def op4_bpe_round_trip(spark, sf_dir):
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"), TOKENIZER)


def op5_substring_dedup(spark, sf_dir):
    return substring.scan_documents(table(spark, sf_dir, "documents"))


def op6_simhash_near_dedup(spark, sf_dir):
    return simhash.scan_documents(table(spark, sf_dir, "documents"))


def op7_warc_derivatives(spark, sf_dir):
    records = warc.page_derivatives(table(spark, sf_dir, "pages"))
    return records.withColumn("block_sha256", F.sha2("block", 256)).withColumn("block_chars", F.length("block")).drop("block")


def op8_language_id(spark, sf_dir):
    return langid.scan_documents(table(spark, sf_dir, "documents"))


def op9_license_scan(spark, sf_dir):
    return licenses.scan_documents(table(spark, sf_dir, "documents"))


def op10_benchmark_decontamination(spark, sf_dir):
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_embedding_whitening(spark, sf_dir):
    return whitening.scan_vectors(table(spark, sf_dir, "embeddings"))


def op12_periodic_runs(spark, sf_dir):
    return periodic.scan_documents(table(spark, sf_dir, "documents"))


def op13_byte_bpe_round_trip(spark, sf_dir):
    return byte_bpe.round_trip_digests(table(spark, sf_dir, "documents"), RANKS)


REGISTERED = {
    f.__name__: f
    for f in (
        op1_quality_classifier, op2_secret_scan, op3_exact_top_k, op4_bpe_round_trip, op5_substring_dedup,
        op6_simhash_near_dedup, op7_warc_derivatives, op8_language_id, op9_license_scan, op10_benchmark_decontamination,
        op11_embedding_whitening, op12_periodic_runs, op13_byte_bpe_round_trip,
    )
}
BASE_SECRETS = {
    "assign": (secret_scan.ASSIGN, 2, secret_scan.LEAST["assign"]),
    "access": (secret_scan.ACCESS, 1, secret_scan.LEAST["access"]),
    "hex": ("([0-9a-f]+)", 1, secret_scan.LEAST["hex"]),
}
# The other queries hold learned models, tokens, XXH64, SHA-1 in base32 or edit distances, which SQL cannot express.
SQL: dict[str, str] = {
    "op2_secret_scan": oracle.secret_scan(
        secret_scan.KINDS, BASE_SECRETS, secret_scan.CLASSES, secret_scan.ALLOWED, secret_scan.PLACEHOLDERS, secret_scan.STRETCH
    ),
    "op3_exact_top_k": oracle.EXACT_TOP_K,
    "op5_substring_dedup": oracle.SUBSTRING_DEDUP,
    "op9_license_scan": oracle.license_scan(licenses.BASE, licenses.TEMPLATES),
}
