"""Topic search without a full scan: trigram postings of the corpus, and a search that reads only where they allow a match.

Papers are taken in granules, ranges of so many ids. The index holds which trigrams occur in the titles and abstracts of
each granule. A search derives the trigrams that its regex requires, looks up the granules that have them, and reads the
papers of those id ranges; the regex itself decides. Ingestion orders a shard's papers by id, so a range is a few row
groups of a few files, and the scan leaves out the others by their statistics.

A regex that requires no trigram, and papers of shards that are not in the index, are searched by a whole scan. The index
grows by shards: papers never change, so what is in it stays true.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.trigrams import ALWAYS, holds, numbers, required, trigrams
from paperloom.operators.extract import in_topic

GRANULE = 128  # ids of a granule
# Id ranges that a scan is told. Neighbouring granules beyond it share a range, which only reads a little more.
RANGES = 200
# Characters of titles and abstracts that one task turns into postings: about 1.3 million postings of plain prose, each some
# 100 bytes in an aggregate and in a sort, and 2 GB if no two trigrams of a granule were alike.
TASK_CHARACTERS = 16_000_000

SCHEMA = "trigram INT, granule BIGINT, partition STRING"


def postings(papers: DataFrame, granule: int = GRANULE, task_characters: int = TASK_CHARACTERS) -> DataFrame:
    """(trigram, granule, partition): which trigrams occur in which granules of a shard.

    The texts are measured and dealt out in ranges of shard and granule, so that what a task holds at once does not grow
    with a shard; a granule stays in one task, and the postings need no further shuffle.
    """
    # A character that is in no trigram keeps those of the title and of the abstract apart.
    text = F.concat_ws("\u0080", "title", "abstract")
    texts = papers.select(text.alias("text"), F.floor(F.col("id") / granule).alias("granule"), "partition")
    characters = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    dealt = texts.repartitionByRange(max(1, -(-characters // task_characters)), "partition", "granule")
    return dealt.select(F.explode(trigrams(F.col("text"))).alias("trigram"), "granule", "partition").distinct()


def write_postings(rows: DataFrame, path: str) -> None:
    """Add the postings of new shards, or replace those of the same shards; a look-up reads few row groups of each.

    They are written as `postings` deals them out: a file for each task, and one more where a task's range leads into
    another shard.
    """
    (
        rows.sortWithinPartitions("partition", "trigram", "granule")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("partition")
        .parquet(path)
    )


def candidates(index: DataFrame, regex: str) -> DataFrame | None:
    """Granules whose papers may match; None if every paper may."""
    formula = required(regex)
    if formula is ALWAYS:
        return None
    found = index.filter(F.col("trigram").isin(sorted(numbers(formula)))).groupBy("granule")
    # At most the formula's trigrams are collected for each granule.
    return found.agg(F.collect_set("trigram").alias("present")).filter(holds(formula, F.col("present"))).select("granule")


def id_ranges(granules: DataFrame, granule: int = GRANULE, ranges: int = RANGES) -> list[tuple[int, int]]:
    """At most so many ranges of ids, ends included, that cover the granules."""
    span = granules.agg(F.min("granule").alias("low"), F.max("granule").alias("high")).first()
    if span.low is None:
        return []
    width = (span.high - span.low) // ranges + 1
    part = F.floor((F.col("granule") - span.low) / width)
    rows = granules.groupBy(part.alias("part")).agg(F.min("granule").alias("low"), F.max("granule").alias("high")).collect()
    return [(r.low * granule, (r.high + 1) * granule - 1) for r in sorted(rows, key=lambda r: r.low)]


def in_ranges(ids: Column, ranges: list[tuple[int, int]]) -> Column:
    return reduce(Column.__or__, (ids.between(low, high) for low, high in ranges), F.lit(False))


def in_topic_indexed(papers: DataFrame, index: DataFrame, regex: str, granule: int = GRANULE, ranges: int = RANGES) -> DataFrame:
    """The papers of a topic; `index` holds the postings of all of them."""
    found = candidates(index, regex)
    if found is None:
        return in_topic(papers, regex)
    return in_topic(papers.filter(in_ranges(F.col("id"), id_ranges(found, granule, ranges))), regex)


def in_topic_by_shards(papers: DataFrame, index: DataFrame, regex: str, granule: int = GRANULE, ranges: int = RANGES) -> DataFrame:
    """The papers of a topic, where the index may lack shards: those are searched as a whole."""
    # A row for each shard: broadcast, or the join would bring all texts of a shard into one task.
    indexed = F.broadcast(index.select("partition").distinct())
    old = papers.join(indexed, "partition", "left_semi")
    new = papers.join(indexed, "partition", "left_anti")
    return in_topic_indexed(old, index, regex, granule, ranges).unionByName(in_topic(new, regex))
