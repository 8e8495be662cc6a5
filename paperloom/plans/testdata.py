"""Adapters: the given tables seen as papers, snapshots, work-lists, shards and responses.

Each is a projection (or one aggregation) over whole tables; no rows are picked out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.registry import CS_CODES
from paperloom.schemas import DONE, ERROR, TODO


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _first_line(text: Column) -> Column:
    return F.substring_index(text, "\n", 1)


def _word(text: Column, position: int) -> Column:
    return F.split_part(text, F.lit(" "), F.lit(position))


def _categories() -> Column:
    """A primary code from the source number and further ones from the language."""
    source_number = F.substring("source", 4, 10).cast("int")
    primary = F.element_at(F.array(*[F.lit(c) for c in CS_CODES]), source_number + 1)
    more = (
        F.when(F.col("lang") == "en", " cs.LG")
        .when(F.col("lang") == "fr", " stat.ML")
        .when(F.col("lang") == "de", " math.OC cs.PL")
        .otherwise(" physics.plasm-ph")
    )
    return F.concat(F.lit("cs."), primary, more)


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as corpus papers."""
    title = _first_line(F.col("text"))
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        F.concat(F.lit("s"), F.col("doc_id").cast("string")).alias("s2_id"),
        title.alias("title"),
        F.col("text").alias("abstract"),
        F.array(_word(title, 1), _word(title, 2)).alias("authors"),
        F.col("source").alias("venue"),
        (F.lit(1990) + F.pmod("doc_id", F.lit(35))).cast("int").alias("year"),
        F.pmod("n_chars", F.lit(100)).cast("int").alias("n_citations"),
        F.col("source").alias("partition"),
    )


def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as snapshot records."""
    title = _first_line(F.col("text"))
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id"),
        title.alias("title"),
        F.col("text").alias("abstract"),
        _categories().alias("categories"),
        F.array(
            F.array(_word(title, 2), _word(title, 1)), F.array(F.col("source"), F.col("lang"), F.lit("jr"))
        ).alias("authors_parsed"),
        F.concat(F.lit("10.1/"), F.col("doc_id")).alias("doi"),
        F.col("source").alias("submitter"),
        F.lit(None).cast("string").alias("comments"),
        F.col("lang").alias("authors"),
        F.lit("cc").alias("license"),
        F.col("lang").alias("journal-ref"),
        F.col("source").alias("report-no"),
        F.lit("2022-01-01").alias("update_date"),
    )


def corpus_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles of documents and of web pages: the corpus side of the match. Page ids are negative."""
    documents = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), _first_line(F.col("text")).alias("title")
    )
    pages = table(spark, sf_dir, "pages").select(
        (-F.col("page_id") - 1).alias("id"),
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
    )
    return documents.unionByName(pages)


def gappy_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers with NULL and empty fields where a document's labels are missing or low."""
    labelled = papers(spark, sf_dir).join(
        table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "id"), "id", "left"
    )
    quality, toxic = F.col("quality"), F.col("toxic")
    return labelled.select(
        "id",
        "title",
        F.when(toxic == 1, "").when(F.col("year") == 1999, None).otherwise(F.col("abstract")).alias("abstract"),
        F.when(quality == 0, "").when(quality == 1, F.col("venue")).alias("venue"),
        F.when(F.col("n_citations") < 90, F.col("year")).alias("year"),
        "n_citations",
        "s2_id",
        "authors",
    )


def shard_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as raw corpus shard records; `partition` is the document's source."""
    title = _first_line(F.col("text"))
    fields = (
        F.when(F.col("lang") == "en", F.array(F.lit("Computer Science")))
        .when(F.col("lang") == "fr", F.array(F.lit("Mathematics"), F.lit("Computer Science")))
        .when(F.col("lang") == "de", F.array(F.lit("Physics")))
    )
    named = F.transform(F.split(title, " "), lambda word: F.struct(word.alias("name")))
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("s"), F.col("doc_id").cast("string")).alias("id"),
        title.alias("title"),
        F.col("text").alias("paperAbstract"),
        named.alias("authors"),
        F.when(F.col("n_chars") >= 500, F.split(title, " ")).alias("inCitations"),
        fields.alias("fieldsOfStudy"),
        F.when(F.col("source") == "src7", "").otherwise(F.col("source")).alias("venue"),
        F.when(F.col("n_chars") >= 300, (F.lit(1990) + F.pmod("doc_id", F.lit(35))).cast("int")).alias("year"),
        F.col("source").alias("partition"),
    )


def seeds(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Regions or benchmark items as seed papers."""
    if name == "region":
        source = table(spark, sf_dir, "region").select(
            F.col("r_regionkey").cast("bigint").alias("id"), F.col("r_name").alias("text")
        )
    else:
        source = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), "text")
    return source.select(
        "id",
        F.concat(F.lit("seed"), F.col("id").cast("string")).alias("s2_id"),
        _first_line(F.col("text")).alias("title"),
        F.col("text").alias("abstract"),
        F.lit("seed venue").alias("venue"),
        F.array(F.lit("A"), F.lit("B")).alias("authors"),
        F.lit(2000).alias("year"),
        F.lit(7).alias("n_citations"),
    )


def worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a work-list: status from the order status, partition from the priority."""
    filled = (
        F.when(F.col("o_orderstatus") == "O", TODO).when(F.col("o_orderstatus") == "F", DONE).otherwise(ERROR)
    )
    urgency = F.substring("o_orderpriority", 1, 1)
    partition = F.when(urgency.isin("1", "5"), 0).when(urgency == "2", 1).when(urgency == "3", 2)
    done = F.col("o_orderstatus") == "F"
    venue = F.when(urgency == "4", "").when(urgency != "2", F.col("o_orderpriority"))
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.when(done, venue).alias("venue"),
        F.when(done, F.year("o_orderdate")).alias("year"),
        F.when(done, F.floor("o_totalprice").cast("int")).alias("n_citations"),
        partition.alias("partition"),
        filled.alias("filled"),
    )


def staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items folded per order as staging rows."""
    flag, first = F.col("flag"), F.col("first_line")
    folded = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.max("l_returnflag").alias("flag"),
            F.min("l_linestatus").alias("status"),
            F.max(F.year("l_shipdate")).alias("shipped"),
            F.count("*").cast("int").alias("n"),
            F.min("l_linenumber").alias("first_line"),
        )
    )
    return folded.select(
        F.col("l_orderkey").cast("string").alias("id"),
        F.when(flag == "R", F.col("status")).alias("venue"),
        F.when(flag == "R", F.col("shipped")).alias("year"),
        F.when(flag == "R", F.col("n")).alias("n_citations"),
        F.when(first == 1, 0).when(first == 2, 1).when(first == 3, 2).alias("partition"),
        F.when(flag == "R", DONE).when(flag == "N", ERROR).otherwise(TODO).alias("filled"),
    )


def repeated_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging as overlapping runs leave it: every row twice, once as an error without values."""
    once = staging(spark, sf_dir)
    again = once.withColumns(
        {**{v: F.lit(None).cast(once.schema[v].dataType) for v in ("venue", "year", "n_citations")}, "filled": F.lit(ERROR)}
    )
    return once.unionByName(again.filter(F.col("id").cast("bigint") % 2 == 0)).unionByName(once)


def repeated_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses with a second one per id: every third asked again without success, the others with a null venue."""
    once = responses(spark, sf_dir)
    number = F.col("id").cast("bigint")
    emptied = F.regexp_replace("body", r'"venue": "v\d+"', '"venue": null')
    again = once.select(
        "id",
        F.when(number % 3 == 0, 404).otherwise(F.col("status")).alias("status"),
        F.when(number % 3 == 0, F.lit('{"error": "gone"}')).otherwise(emptied).alias("body"),
    )
    return again.unionByName(once)


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as completion responses: complete, partial, failed, forbidden and unreadable ones."""
    kind, value = F.col("event_type"), F.col("value")
    user = F.col("user_id").cast("string")
    year = F.when(value < 5, "null").otherwise("2001")
    complete = F.concat(
        F.lit('{"venue": "v'), user, F.lit('", "year": '), year, F.lit(', "citationCount": '), user, F.lit("}")
    )
    failed = F.concat(F.lit('{"error": "no paper '), user, F.lit('"}'))
    body = (
        F.when(kind == "click", complete)
        .when(kind == "view", F.replace(complete, F.lit("citationCount"), F.lit("citations")))
        .when((kind == "signup") & (value < 5), F.concat(F.lit("["), user, F.lit("]")))
        .when(kind == "signup", failed)
        .when((kind == "error") & (value < 5), "<html>forbidden</html>")
        .when((kind == "error") & (value < 10), F.lit("[403]"))
        .when((kind == "purchase") & (value < 5), "null")
        .otherwise(F.col("props"))
    )
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("id"),
        F.when(kind == "error", 403).when(kind == "purchase", 404).otherwise(200).alias("status"),
        body.alias("body"),
    )
