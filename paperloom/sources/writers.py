"""Sinks.

A sink partitioned by label asks for a rebalance on the label first: AQE then writes few files for a small label
and splits one that holds most of the rows over many tasks. Variants are rebalanced on seed and feature, so that the
number of files follows the output and not tasks x seeds, unless their folders are known to be few. Those and masks are
not shuffled: each task holds every folder's rows in equal measure and writes its few folders side by side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions.text import record_json

from paperloom.operators.worklist import insert_or_ignore


def _balanced(df: DataFrame, *columns: str) -> DataFrame:
    return df.hint("rebalance", *columns)


def write_category_papers(df: DataFrame, path: str) -> None:
    """Papers of the labels in column `cate`, one JSON object per line and NULL fields left out."""
    _balanced(df, "cate").write.mode("overwrite").partitionBy("cate").json(path)


# Variants and masks repeat each paper several times, so they can be written compressed; readers take either. The fast level
# takes a third of the default one's CPU time for files a tenth larger.
PLAIN, COMPRESSED = "none", "gzip"
QUICKLY = {"zlib.compress.level": "BEST_SPEED"}

LAYOUTS = ("lines", "pretty", "one line")
ROWS_PER_ARRAY = 1_000_000


def write_json_arrays(df: DataFrame, path: str, key: str = "id", layout: str = "lines", rows_per_file: int = ROWS_PER_ARRAY) -> None:
    """JSON array files of about so many rows, ordered by `key` and dealt by its hash; NULL fields are left out.

    `layout` is one object per line, pretty-printed, or all on one line. No rows make one file with an empty array.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"no layout {layout!r}, only {LAYOUTS}")
    files = max(1, -(-df.count() // rows_per_file))
    record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"pretty": "true"} if layout == "pretty" else {})
    rows = df.select(F.pmod(F.xxhash64(key), F.lit(files)).alias("file"), F.struct(F.col(key).alias("key"), record.alias("record")).alias("r"))
    order = Window.partitionBy("file").orderBy("r")
    first, last = F.row_number().over(order) == 1, F.lead("r").over(order).isNull()
    value = F.concat(F.when(first, "[").otherwise(","), F.lit(" "), F.col("r.record"), F.when(last, "]").otherwise(""))
    lines = rows.select("file", value.alias("value"))
    nothing = df.sparkSession.sql("SELECT 0L AS file, '[]' AS value").filter(F.lit(df.isEmpty()))
    separator = " " if layout == "one line" else "\n"
    lines.unionByName(nothing).write.mode("overwrite").option("lineSep", separator).partitionBy("file").text(path)


def write_records(df: DataFrame, path: str) -> None:
    """Papers as JSON lines; NULL fields are written as null."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


# The keys a completed paper always has, also without a value.
ALWAYS = ("year", "venue", "n_citations")


def completed_json(papers: DataFrame, column: str = "value") -> DataFrame:
    """Completed papers as JSON text: the keys each paper has, and the completed fields also where they are null."""
    own = record_json(*[F.col(f"`{c}`") for c in papers.columns if c not in ALWAYS])
    filled = F.to_json(F.struct(*ALWAYS), {"ignoreNullFields": "false"})
    # Both are objects with at least one key (the id and the fields above): join them at their braces.
    return papers.select(F.concat(F.substr(own, F.lit(1), F.length(own) - 1), F.lit(","), F.substr(filled, F.lit(2))).alias(column))


def write_completed(papers: DataFrame, path: str) -> None:
    """Completed papers, one JSON object per line."""
    completed_json(papers).write.mode("overwrite").text(path)


def write_label_index(index: DataFrame, path: str) -> None:
    _balanced(index.select("id", "cate"), "cate").write.mode("overwrite").partitionBy("cate").parquet(path)


def write_one_label(index: DataFrame, path: str, cate: str) -> None:
    """Replace one label's part of the index, also by nothing."""
    index.filter(F.col("cate") == cate).select("id").write.mode("overwrite").parquet(f"{path}/cate={cate}")


def export_label_index(index: DataFrame, path: str) -> None:
    """The label index as text, one id per line, one folder per label."""
    lines = index.select(F.col("id").cast("string").alias("value"), "cate")
    _balanced(lines, "cate").write.mode("overwrite").partitionBy("cate").text(path)


def write_match_audit(audit: DataFrame, path: str) -> None:
    _balanced(audit, "cate").write.mode("overwrite").partitionBy("cate").json(path)


def write_variants(variants: DataFrame, path: str, folders: int | None = None, compression: str = PLAIN) -> None:
    """One folder per seed, source and changed feature.

    `folders` is their number, if known: when a task can write so many side by side, nothing is shuffled.
    """
    side_by_side = int(variants.sparkSession.conf.get("spark.sql.maxConcurrentOutputFileWriters"))
    rows = variants if folders is not None and folders <= side_by_side else _balanced(variants, "seed_id", "feature")
    (
        rows.write.mode("overwrite")
        .option("ignoreNullFields", "false")
        .options(compression=compression, **QUICKLY)
        .partitionBy("seed_id", "source", "feature")
        .json(path)
    )


def write_masked(masked: DataFrame, path: str, compression: str = PLAIN) -> None:
    """One folder of JSON lines per mask."""
    masked.write.mode("overwrite").options(compression=compression, **QUICKLY).partitionBy("masking").text(path)


def append_new(new: DataFrame, existing: DataFrame, path: str, key: str = "id") -> None:
    """Append the rows whose key the table does not hold yet."""
    insert_or_ignore(existing, new, key).write.mode("append").parquet(path)


def write_snapshot(df: DataFrame, path: str) -> None:
    """A new version of a small mutable table. `path` must not be one the plan reads."""
    df.write.mode("overwrite").parquet(path)
