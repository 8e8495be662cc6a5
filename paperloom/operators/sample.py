"""Random order at scale: dense ids, exact samples and the three-way split.

All three need positions in a global order. A global `row_number()` would pass every row through one task;
here the hash prefix cuts the order into at most 16**4 balanced buckets, a map-side combined count per
bucket gives each bucket's offset, and positions are only counted inside a bucket. Keys must be distinct
(within a group): equal keys would share a bucket, so callers drop duplicates first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions.ordering import bucket, order_hash

# Groups whose cut rows may travel with the plan.
MAX_CUT_ROWS = 10_000

_HASH, _BUCKET, _OFFSET, _TOTAL = "_hash", "_bucket", "_offset", "_total"


def _hashed(df: DataFrame, key: str, seed: int) -> DataFrame:
    return df.withColumn(_HASH, order_hash(F.col(key), seed)).withColumn(_BUCKET, bucket(F.col(_HASH)))


def _bucket_offsets(hashed: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows before each bucket, and in all of them. At most 16**4 rows per group, whatever the input size."""
    group = Window.partitionBy(*by)
    upto = group.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = hashed.groupBy(*by, _BUCKET).agg(F.count("*").alias("_size"))
    return counts.withColumns(
        {_OFFSET: F.sum("_size").over(upto) - F.col("_size"), _TOTAL: F.sum("_size").over(group)}
    ).drop("_size")


def _placed(df: DataFrame, key: str, seed: int, name: str) -> DataFrame:
    """1-based position in the seeded order, and the number of rows in `_TOTAL`."""
    hashed = _hashed(df, key, seed)
    # Bounded broadcast: one row per hash prefix, 16**4 at most.
    placed = hashed.join(F.broadcast(_bucket_offsets(hashed)), _BUCKET)
    inside = F.row_number().over(Window.partitionBy(_BUCKET).orderBy(_HASH, key))
    return placed.withColumn(name, F.col(_OFFSET) + inside).drop(_HASH, _BUCKET, _OFFSET)


def with_position(df: DataFrame, key: str, seed: int, name: str = "position") -> DataFrame:
    """1-based position of each row in the seeded order of `key`."""
    return _placed(df, key, seed, name).drop(_TOTAL)


def dense_id(df: DataFrame, key: str, seed: int, name: str = "id") -> DataFrame:
    """Surrogate ids 1..N without gaps."""
    return with_position(df, key, seed, name)


def sample(
    df: DataFrame, key: str, n: int, seed: int, by: Sequence[str] = (), max_cut_rows: int = MAX_CUT_ROWS
) -> DataFrame:
    """Exactly `n` rows (all if there are fewer), the first in the seeded order; per group if `by` is given.

    The first pass, run at once, counts hash prefixes of the key column alone and finds the prefix in which
    row `n` falls: one row per group. The plan returned filters on that prefix, so hardly more than `n` rows
    are ranked. `by` is for label-like columns: the cut is broadcast if there are at most `max_cut_rows`
    groups, else joined by a shuffle. `df` is read twice; checkpoint it if that is costly.
    """
    hashed = _hashed(df, key, seed)
    reached = _bucket_offsets(hashed.select(*by, _HASH, _BUCKET), by).filter(F.col(_OFFSET) < n)
    cut = reached.groupBy(*by).agg(F.max(_BUCKET).alias("_last"), F.max(_OFFSET).alias(_OFFSET))
    rows = cut.limit(max_cut_rows + 1).collect()
    if not by:
        last, offset = rows[0]
        kept = hashed.filter(F.col(_BUCKET) <= last).withColumns({"_last": F.lit(last), _OFFSET: F.lit(offset)})
    else:
        if len(rows) <= max_cut_rows:
            cut = F.broadcast(df.sparkSession.createDataFrame(rows, cut.schema))
        kept = hashed.join(cut, list(by)).filter(F.col(_BUCKET) <= F.col("_last"))
    inside = F.row_number().over(Window.partitionBy(*by, _BUCKET).orderBy(_HASH, key))
    return (
        kept.withColumn("_rank", inside)
        .filter((F.col(_BUCKET) < F.col("_last")) | (F.col(_OFFSET) + F.col("_rank") <= n))
        .drop(_HASH, _BUCKET, "_last", _OFFSET, "_rank")
    )


def three_way_part(position: Column, total: Column) -> Column:
    """Part 0, 1 or 2 of a 1-based position; the first two have floor(total / 3) rows, the last the rest."""
    third = F.floor(total / 3)
    return F.when(position <= third, 0).when(position <= 2 * third, 1).otherwise(2)


def three_way_split(df: DataFrame, key: str, seed: int) -> DataFrame:
    """Random split of distinct keys into column `partition`."""
    return (
        _placed(df, key, seed, "_position")
        .withColumn("partition", three_way_part(F.col("_position"), F.col(_TOTAL)).cast("int"))
        .drop("_position", _TOTAL)
    )
