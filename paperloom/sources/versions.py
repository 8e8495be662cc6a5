"""Small mutable tables, kept as a base and the change sets after it, so that what is written follows what has changed.

A change set holds the whole new rows of the keys it changes or adds. Reading lays the newest row of each key over the base.
Versions are numbered; one counts when its write has left its success mark, so a job that breaks off at any point leaves the
old state, and the next job writes the same number again. After MOST_CHANGES change sets the table is written as a new base,
under the number of the last change set in it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paperloom.sources.readers import finished_versions
from paperloom.sources.writers import write_snapshot

MOST_CHANGES = 20


def _finished(spark: SparkSession, path: str) -> tuple[int, list[int]]:
    """Number of the newest base (-1: none) and of the change sets after it."""
    base = max(finished_versions(spark, path), default=-1)
    return base, [n for n in finished_versions(spark, path, "change") if n > base]


def read_version(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, int]:
    """The newest state of a table, whose first column is its key, and the state's number; without one an empty table, -1."""
    base, changes = _finished(spark, path)
    rows = spark.read.schema(schema).parquet(f"{path}/snapshot={base}") if base >= 0 else spark.createDataFrame([], schema)
    if not changes:
        return rows, base
    key, names = schema.fieldNames()[0], schema.fieldNames()
    changed = spark.read.schema(StructType([*schema.fields]).add("change", "long")).option("basePath", path)
    changed = changed.parquet(*[f"{path}/change={n}" for n in changes])
    newest = changed.groupBy(key).agg(F.max_by(F.struct(*names), "change").alias("row")).select("row.*")
    kept = rows.join(changed.select(key).distinct(), key, "left_anti").select(*names)
    return kept.unionByName(newest), changes[-1]


def commit_changes(rows: DataFrame, path: str, version: int, schema: StructType, most_changes: int = MOST_CHANGES) -> None:
    """Make `rows` (whole rows, one per key) the change after `version`, the number that `read_version` gave."""
    spark = rows.sparkSession
    write_snapshot(rows.select(*schema.fieldNames()), f"{path}/change={version + 1}")
    if len(_finished(spark, path)[1]) > most_changes:
        table, number = read_version(spark, path, schema)
        write_snapshot(table, f"{path}/snapshot={number}")


def changed_rows(after: DataFrame, before: DataFrame) -> DataFrame:
    """Rows of `after` that `before` does not have, NULLs being equal."""
    return after.subtract(before.select(*after.columns))
