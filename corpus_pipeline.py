"""The training-data pipeline: each stage is written as Parquet and read again as the next one's documents."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm import bpe, decontaminate, quality, secret_scan, simhash
from paperloom.llm.queries import TOKENIZER
from paperloom.llm.tables import free_name, table
from paperloom.session import configure, shared_dir


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text the quality classifier accepts."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of SimHash links (4-word shingles, at most 4 differing bits): the smallest doc_id."""
    return simhash.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced in their texts and n_chars counted anew where one was."""
    name = free_name(docs, "spans")
    spans = secret_scan.with_spans(docs, "text", name)
    changed = F.size(name) > 0
    out = spans.withColumn("text", secret_scan.redacted(F.col("text"), F.col(name)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of each remaining document's text."""
    return bpe.round_trip_digests(docs, TOKENIZER)


STAGES = [
    ("quality classifier", keep_quality),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_leaks),
    ("secret scans", redact_secrets),
    ("BPE encoding and decoding", tokenise),
]
# The classifier is learned and tokens come from a vocabulary, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to `documents`."""
    configure(spark)
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return docs
