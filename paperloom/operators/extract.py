"""Selecting and reshaping papers: categories, topics, shard records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.text import author_names, record_json, regex_search, title_key, topic_match
from paperloom.operators.sample import sample
from paperloom.registry import Category
from paperloom.schemas import CORRUPT

# Snapshot keys that are not kept.
UNUSED_SNAPSHOT_KEYS = (
    "doi",
    "submitter",
    "comments",
    "authors",
    "versions",
    "license",
    "journal-ref",
    "categories",
    "update_date",
)

# Fixed value: the field a corpus paper must belong to.
FIELD_OF_STUDY = "Computer Science"


def in_category(papers: DataFrame, category: Category) -> DataFrame:
    return papers.filter(regex_search(F.col("categories"), category.regex))


def labels_of(categories: Column, registry: list[Category]) -> Column:
    """Names of all registry entries whose regex occurs in `categories`, in registry order."""
    return F.array_compact(
        F.array(*[F.when(regex_search(categories, c.regex), F.lit(c.name)) for c in registry])
    )


def label_papers(papers: DataFrame, registry: list[Category]) -> DataFrame:
    """One row per paper and label, in one scan for the whole registry."""
    return papers.withColumn("cate", F.explode(labels_of(F.col("categories"), registry)))


def drop_unused(papers: DataFrame) -> DataFrame:
    return papers.drop(*UNUSED_SNAPSHOT_KEYS)


def category_papers(snapshot: DataFrame, category: Category) -> DataFrame:
    return drop_unused(in_category(snapshot, category))


def category_count(papers: DataFrame, category: Category) -> DataFrame:
    return papers.agg(
        F.count_if(regex_search(F.col("categories"), category.regex)).alias("matched"),
        F.count("*").alias("total"),
    )


def is_topic(regex: str) -> Column:
    return topic_match(F.col("title"), F.col("abstract"), regex)


def in_topic(papers: DataFrame, regex: str) -> DataFrame:
    return papers.filter(is_topic(regex))


def topic_count(papers: DataFrame, regex: str) -> DataFrame:
    return papers.agg(F.count_if(is_topic(regex)).alias("matched"), F.count("*").alias("total"))


def pick(ids: DataFrame, limit: int | None, seed: int) -> DataFrame:
    """`limit` random rows of distinct ids, or all of them."""
    return ids if limit is None else sample(ids, "id", limit, seed)


def ragged_json(papers: DataFrame, column: str = "value") -> DataFrame:
    """Each row as JSON text that leaves out the row's own NULL fields."""
    return papers.select(record_json("*").alias(column))


def completed_authors(papers: DataFrame) -> DataFrame:
    """Replace parsed author name parts by display names."""
    return papers.withColumn("authors", author_names(F.col("authors_parsed"))).drop("authors_parsed")


def belongs_to(field: str = FIELD_OF_STUDY) -> Column:
    """NULL fields of study count as no."""
    return F.array_contains(F.col("fieldsOfStudy"), field)


def is_complete() -> Column:
    """Venue is not empty (NULL passes), abstract is present and not empty, year is present."""
    return ~F.col("venue").eqNullSafe("") & (F.col("abstract") != "") & F.col("year").isNotNull()


def reshape_shard_records(records: DataFrame) -> DataFrame:
    """Raw corpus records to paper columns, for the complete papers of the wanted field."""
    return (
        records.filter(belongs_to())
        .withColumn("abstract", F.col("paperAbstract"))
        .filter(is_complete() & F.col("title").isNotNull())
        .select(
            F.col("id").alias("s2_id"),
            "title",
            "abstract",
            F.col("authors.name").alias("authors"),
            "venue",
            "year",
            F.coalesce(F.size("inCitations"), F.lit(0)).alias("n_citations"),
            title_key(F.col("title")).alias("title_key"),
            "partition",
            *[c for c in ("file",) if c in records.columns],
        )
    )


def unusable_metrics(records: DataFrame) -> list[Column]:
    """Counts of raw records that lack a field that selecting them needs, or are no records; all are passed over."""
    broken = F.col(CORRUPT).isNotNull() if CORRUPT in records.columns else F.lit(False)
    return [
        F.count("*").alias("total"),
        F.count_if(broken).alias("unparsable"),
        F.count_if(F.col("fieldsOfStudy").isNull() & ~broken).alias("no_field_of_study"),
        F.count_if(F.col("title").isNull() & ~broken).alias("no_title"),
        F.count_if(F.col("paperAbstract").isNull() & ~broken).alias("no_abstract"),
    ]


def unusable_counts(records: DataFrame) -> DataFrame:
    return records.agg(*unusable_metrics(records))
