"""Counts over the corpus and the label index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.operators.extract import in_topic
from paperloom.registry import Category, label_table


def corpus_count(papers: DataFrame) -> DataFrame:
    return papers.agg(F.count("*").alias("n_papers"))


def corpus_topic_count(papers: DataFrame, regex: str, checked_shards: DataFrame) -> DataFrame:
    """Papers of the checked shards that match a topic."""
    return count_in_shards(in_topic(papers.select("title", "abstract", "partition"), regex), checked_shards)


def count_in_shards(papers: DataFrame, shards: DataFrame) -> DataFrame:
    counted = papers.groupBy("partition").agg(F.count("*").alias("n")).join(shards, "partition", "left_semi")
    return counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_papers"))


def label_counts(index: DataFrame, registry: list[Category]) -> DataFrame:
    """Papers per label, largest first and ties in registry order; labels without papers count 0."""
    counted = index.groupBy("cate").agg(F.count("*").alias("n"))
    return (
        label_table(index.sparkSession, registry)
        .join(counted, "cate", "left")
        .select("cate", F.coalesce("n", F.lit(0)).alias("count"), "ord")
        .orderBy(F.desc("count"), "ord")
    )


def label_totals(counts: DataFrame) -> DataFrame:
    """Per-label counts with a grand-total row (`cate` NULL) that also holds the number of labels."""
    return counts.rollup("cate").agg(F.sum("count").alias("count"), F.count("*").alias("n_labels"))
