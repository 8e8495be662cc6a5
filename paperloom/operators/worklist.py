"""Work-list of papers to complete, its staging table and their status.

State changes are functions from tables to a new table; the caller writes the result as a new snapshot.
SQL three-valued logic matters here: `is not` predicates keep NULLs, hence `eqNullSafe`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.text import eta
from paperloom.operators.sample import three_way_split
from paperloom.schemas import DONE, ERROR, TODO

# Fixed value: the partition argument that means "all".
ALL_PARTITIONS = -1


def in_partition(partition: int) -> Column:
    wanted = (0, 1, 2) if partition == ALL_PARTITIONS else (partition,)
    return F.col("partition").isin(*wanted)


def insert_or_ignore(existing: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """The rows of `new` an insert would add: one per key, and only keys the table lacks."""
    return new.dropDuplicates([key]).join(existing.select(key), key, "left_anti")


def new_rows(ids: DataFrame, existing: DataFrame, seed: int, full: int | None = None) -> DataFrame:
    """Open rows of the ids that `existing` lacks, split in three. With `full`, a list of just that size gets none."""
    split = three_way_split(ids.select("id").distinct(), "id", seed)
    if full is not None:
        split = split.filter(existing.agg(F.count("*")).scalar() != full)
    open_rows = (
        split.select(
            "id",
            F.lit(None).cast("string").alias("venue"),
            F.lit(None).cast("int").alias("year"),
            F.lit(None).cast("int").alias("n_citations"),
            "partition",
            F.lit(TODO).alias("filled"),
        )
    )
    return insert_or_ignore(existing, open_rows)


def create_worklist(ids: DataFrame, existing: DataFrame, seed: int, full: int | None = None) -> DataFrame:
    """`existing` plus the rows of the ids it lacks."""
    return existing.unionByName(new_rows(ids, existing, seed, full))


def pending(main: DataFrame, staging: DataFrame, partition: int = ALL_PARTITIONS) -> DataFrame:
    """Open rows of a partition that staging has not settled."""
    settled = staging.filter(in_partition(partition) & ~F.col("filled").eqNullSafe(TODO)).select("id")
    return (
        main.filter(in_partition(partition) & (F.col("filled") == TODO))
        .select("id", "partition")
        .join(settled, "id", "left_anti")
    )


def fill_status(main: DataFrame, staging: DataFrame, partition: int = ALL_PARTITIONS) -> DataFrame:
    """One row: distinct done and failed ids of both tables, open ids and row count of the main table, ETA.

    An id settled in staging only still counts as open. `pending_net` leaves those out.
    """
    return _status(_fold(_states(main, staging, partition), "id"))


def fill_status_by_partition(main: DataFrame, staging: DataFrame) -> DataFrame:
    """The status of all partitions (column `part` -1) and of each that has rows, from one pass over both tables.

    An id counts in a partition with the rows it has there, and once in all of them.
    """
    rows = _states(main, staging, ALL_PARTITIONS)
    parts = rows.withColumn("part", F.explode(F.array(F.lit(ALL_PARTITIONS), "partition")))
    return _status(_fold(parts, "part", "id"), "part")


def _states(main: DataFrame, staging: DataFrame, partition: int) -> DataFrame:
    """Rows of both tables that are in one of the three states, and which table each is from."""
    state = F.col("filled").isin(TODO, DONE, ERROR) & in_partition(partition)
    tables = [t.filter(state).select("id", "filled", "partition", F.lit(n).alias("in_main")) for t, n in ((main, 1), (staging, 0))]
    return tables[0].unionByName(tables[1])


def _fold(rows: DataFrame, *keys: str) -> DataFrame:
    """What is known of each id. One shuffle: partial sums fold duplicates before it."""
    return rows.groupBy(*keys).agg(
        F.sum("in_main").alias("main_rows"),
        F.max((F.col("filled") == DONE)).alias("done"),
        F.max((F.col("filled") == ERROR)).alias("failed"),
        F.max((F.col("filled") == TODO) & (F.col("in_main") == 1)).alias("open"),
        F.max((F.col("filled") != TODO) & (F.col("in_main") == 0)).alias("staged"),
    )


def _status(per_id: DataFrame, *by: str) -> DataFrame:
    return per_id.groupBy(*by).agg(
        F.count_if("done").alias("filled"),
        F.count_if("open").alias("unfilled"),
        F.count_if("failed").alias("error"),
        F.coalesce(F.sum("main_rows"), F.lit(0)).alias("total"),
        F.count_if(F.col("open") & ~F.col("staged")).alias("pending_net"),
    ).withColumn("eta", eta(F.col("unfilled")))


VALUES = ("venue", "year", "n_citations")


def best_outcome(filled: Column) -> Column:
    """Aggregate: of several outcomes of an id a done one before an error, then one with more values present.

    What is left of ties is decided by the values themselves, so the choice does not depend on the order of rows.
    """
    rank = F.when(filled == DONE, 0).when(filled == ERROR, 1).otherwise(2)
    absent = sum((F.col(v).isNull().cast("int") for v in VALUES), F.lit(0))
    return F.min(F.struct(rank.alias("rank"), absent.alias("absent"), *VALUES, filled.alias("filled")))


def fold_staging(staging: DataFrame) -> DataFrame:
    """One row per id: overlapping runs may have staged a paper more than once."""
    rows = staging.filter(F.col("filled").isin(TODO, DONE, ERROR))
    folded = rows.groupBy("id").agg(best_outcome(F.col("filled")).alias("o"))
    return folded.select("id", *[f"o.{v}" for v in VALUES], "o.filled")


def merge_staging(main: DataFrame, staging: DataFrame) -> DataFrame:
    """Copy staged values into rows of the main table that are still open; ids stay distinct."""
    values = (*VALUES, "filled")
    staged = fold_staging(staging).select(
        "id", F.lit(True).alias("_staged"), *[F.col(v).alias(f"_{v}") for v in values]
    )
    takes = F.col("filled").eqNullSafe(TODO) & F.col("_staged")
    return main.join(staged, "id", "left").select(
        "id",
        *[F.when(takes, F.col(f"_{v}")).otherwise(F.col(v)).alias(v) for v in values[:3]],
        "partition",
        F.when(takes, F.col("_filled")).otherwise(F.col("filled")).alias("filled"),
    )


def merged_rows(main: DataFrame, staging: DataFrame) -> DataFrame:
    """Only the rows that `merge_staging` changes."""
    still_open = main.filter(F.col("filled").eqNullSafe(TODO)).select("id", "partition")
    return still_open.join(fold_staging(staging), "id").select("id", *VALUES, "partition", "filled")


def merged_count(staging: DataFrame) -> DataFrame:
    """Number of settled staging rows."""
    return staging.agg(F.count_if(F.col("filled").isin(DONE, ERROR)).alias("merged"))


def reset_outside(main: DataFrame, keep: int) -> DataFrame:
    """Reopen every row whose partition is not `keep`, NULL included."""
    kept = F.col("partition").eqNullSafe(keep)
    values = {v: F.when(kept, F.col(v)) for v in ("venue", "year", "n_citations")}
    return main.withColumns({**values, "filled": F.when(kept, F.col("filled")).otherwise(TODO)})


def reset_rows(main: DataFrame, keep: int) -> DataFrame:
    """Only the rows that `reset_outside` changes."""
    blank = F.col("filled").eqNullSafe(TODO)
    for v in VALUES:
        blank = blank & F.col(v).isNull()
    return reset_outside(main.filter(~F.col("partition").eqNullSafe(keep) & ~blank), keep)


def init_checklist(manifest: DataFrame, existing: DataFrame) -> DataFrame:
    """Checklist with every shard of the manifest, unchecked if new."""
    fresh = manifest.select("partition", F.lit(0).alias("is_checked"))
    return existing.unionByName(insert_or_ignore(existing, fresh, "partition"))


def unchecked(checklist: DataFrame) -> DataFrame:
    return checklist.filter(F.col("is_checked").eqNullSafe(0)).select("partition")


def checked(checklist: DataFrame) -> DataFrame:
    return checklist.filter(F.col("is_checked").eqNullSafe(1)).select("partition")


def mark_checked(checklist: DataFrame, done: DataFrame) -> DataFrame:
    """Check the shards listed in `done`."""
    ticked = done.select("partition").distinct().withColumn("_done", F.lit(True))
    return checklist.join(ticked, "partition", "left").select(
        "partition", F.when(F.col("_done"), 1).otherwise(F.col("is_checked")).alias("is_checked")
    )
