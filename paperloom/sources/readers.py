"""Sources. All are lazy and splittable except gzip shards (one task per shard, a property of gzip)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paperloom import schemas
from paperloom.functions.text import decoded_path, shard_name
from paperloom.sources.json_arrays import read_json_array  # noqa: F401


def with_further_keys(spark: SparkSession, path: str, schema: StructType) -> StructType:
    """`schema` and, behind it, every further key that the JSON records have. Takes a pass over the records."""
    known = set(schema.fieldNames())
    return StructType([*schema.fields, *(f for f in spark.read.json(path).schema.fields if f.name not in known)])


def read_snapshot(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Metadata snapshot, one JSON object per line. Without `schema` further keys of the records are kept as well."""
    return spark.read.schema(schema or with_further_keys(spark, path, schemas.SNAPSHOT)).json(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """Compressed corpus shards with the shard's name from the file name, and the file."""
    return with_shard(spark.read.schema(schemas.SHARD_LINE).option("columnNameOfCorruptRecord", schemas.CORRUPT).json(path))


def with_shard(lines: DataFrame) -> DataFrame:
    """Name the shard and the file each row was read from; the same names in batches, streams and listings."""
    return lines.withColumns(
        {
            "partition": shard_name(decoded_path(F.col("_metadata.file_name"))),
            "file": decoded_path(F.col("_metadata.file_path")),
        }
    )


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Shard names listed in a text manifest."""
    return spark.read.text(path).select(shard_name(F.col("value")).alias("partition")).filter("partition <> ''")


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """Numeric ids, one per line; blank lines are skipped."""
    return (
        spark.read.text(path)
        .select(F.trim(F.col("value")).alias("line"))
        .filter("line <> ''")
        .select(F.col("line").cast("bigint").alias("id"))
    )


def read_records(spark: SparkSession, path: str, schema: StructType = schemas.PAPER_RECORD) -> DataFrame:
    """Exported papers, seeds or completed papers, one JSON object per line."""
    return spark.read.schema(schema).json(path)


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    """Seed papers with all the keys they have."""
    return read_records(spark, path, with_further_keys(spark, path, schemas.PAPER_RECORD))


def read_papers(
    spark: SparkSession, path: str, columns: Iterable[str] | None = None, shards: Iterable[str] | DataFrame | None = None
) -> DataFrame:
    """Corpus table; `columns` prunes the scan and `shards` its partitions.

    A table of shards (column `partition`) is joined: the planner prunes partitions by its values when the query runs, and
    the list may be of any length.
    """
    papers = spark.read.schema(schemas.PAPERS).parquet(path)
    if isinstance(shards, DataFrame):
        papers = papers.join(shards.select("partition"), "partition", "left_semi")
    elif shards is not None:
        papers = papers.filter(F.col("partition").isin(list(shards)))
    return papers if columns is None else papers.select(*columns)


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """Fetched completion responses."""
    return spark.read.schema(schemas.RESPONSES).json(path)


def read_table(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def read_table_or_empty(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A table nobody has written yet reads as an empty one."""
    return read_table(spark, path, schema) if exists(spark, path) else spark.createDataFrame([], schema)


def exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def finished_versions(spark: SparkSession, path: str, kind: str = "snapshot") -> list[int]:
    """Numbers of the `<kind>=<n>` folders whose write came to its end, from their names alone."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    folder = hadoop_path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    found = [status.getPath() for status in files.listStatus(folder) if status.isDirectory()]
    named = [(p.getName().partition("="), p) for p in found]
    return sorted(int(n) for (key, _, n), p in named if key == kind and files.exists(hadoop_path(p, "_SUCCESS")))
