"""Incremental ingestion of corpus shards: a file stream into the partitioned corpus table.

The stream's own checkpoint knows which shard files were read. A batch that is replayed after a crash
overwrites its own shards and gives them the same ids, so nothing is doubled or lost.

A batch is bounded by the bytes of its files, so that a few large shards and thousands of small ones cost alike. A
compressed shard is parsed by one task, as it cannot be split; its rows are staged in files that can, so numbering and
writing are spread over all tasks however unequal the shards are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from paperloom import schemas
from paperloom.operators.extract import reshape_shard_records, unusable_metrics
from paperloom.session import durable
from paperloom.sources.readers import read_table_or_empty, with_shard

# Bytes of shard files per micro-batch (one file may be larger), rows after which the writer starts another file of a
# shard, and rows of a staged file (a task of the second scan reads one or more of them).
BYTES_PER_BATCH = 256 << 30
ROWS_PER_FILE = 2_000_000
ROWS_PER_STAGED_FILE = 250_000

# A shard may carry any time stamp: the stream must not pass over files older than the newest one by more than this.
NO_AGE_LIMIT = "100000d"

# monotonically_increasing_id(): the task number is above this many bits.
_TASK_SHIFT = 33

# One batch between parsing and numbering.
_STAGED = schemas.without(schemas.PAPERS, "id")
for _extra, _kind in (("file", schemas.TEXT), ("_place", schemas.BIGINT), ("task", schemas.BIGINT)):
    _STAGED = schemas.plus(_STAGED, _extra, _kind)

# Shards of finished runs.
_READ = schemas.only(schemas.PAPERS, "partition")


def _shard_stream(spark: SparkSession, landing: str, bytes_per_batch: int) -> DataFrame:
    return with_shard(
        spark.readStream.schema(schemas.SHARD_LINE)
        .option("columnNameOfCorruptRecord", schemas.CORRUPT)
        .option("maxBytesPerTrigger", bytes_per_batch)
        .option("maxFileAge", NO_AGE_LIMIT)
        .json(landing)
    )


def _rows_before(chunks: DataFrame, batch_id: int) -> int:
    """Papers of earlier batches. Fails if two files have the same shard name: the later would replace the earlier's papers."""
    earlier = F.when(F.col("batch") < batch_id, F.col("n"))
    shards = chunks.filter(F.col("batch") <= batch_id).groupBy("partition").agg(
        F.min("file").alias("a"), F.max("file").alias("b"), F.sum(earlier).alias("n")
    )
    clash = F.min(F.when(F.col("a") != F.col("b"), F.struct("partition", "a", "b")))
    found = shards.agg(clash.alias("clash"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    if found.clash is not None:
        name, a, b = found.clash
        raise ValueError(f"two files make the shard {name!r}: {a} and {b}; rename one of them")
    return found.n


def write_batch(batch: DataFrame, batch_id: int, papers_path: str, chunks_path: str) -> None:
    """Number a batch of shard records and write it to the corpus table.

    Ids are dense over the whole corpus without sorting it: rows keep their place in the scan, each (shard,
    task) chunk is contiguous there, and a chunk's first id follows from the row counts before it. The rows
    are written with their place before they are counted: each shard is decompressed and parsed once, and a
    place cannot change any more (a second scan could be split over tasks differently).

    Records passed over are counted in the same scan. A shard name that belongs to another file fails the batch.
    """
    spark = batch.sparkSession
    staged, own_chunks = f"{chunks_path}_staged", f"{chunks_path}/batch={batch_id}"
    passed_over = Observation("passed over")
    watched = batch.observe(passed_over, *unusable_metrics(batch))
    placed = reshape_shard_records(watched).withColumn("_place", F.monotonically_increasing_id())
    placed = placed.withColumn("task", F.shiftright("_place", _TASK_SHIFT))
    placed.write.mode("overwrite").option("maxRecordsPerFile", ROWS_PER_STAGED_FILE).parquet(staged)
    rows = spark.read.schema(_STAGED).parquet(staged)
    contiguous = F.max("_place") - F.min("_place") + 1 == F.count("*")
    gap = F.raise_error(F.concat(F.lit("rows of one shard are apart in a task: "), F.first("partition")))
    (
        rows.groupBy("partition", "task", "file")
        .agg(F.min("_place").alias("first_place"), F.when(contiguous, F.count("*")).otherwise(gap).alias("n"))
        .write.mode("overwrite")
        .parquet(own_chunks)
    )
    base = _rows_before(spark.read.schema(schemas.plus(schemas.CHUNKS, "batch", schemas.BIGINT)).parquet(chunks_path), batch_id)
    # One row per shard and task of this batch: small enough for one window, read back with its true size.
    before = Window.orderBy("partition", "task").rowsBetween(Window.unboundedPreceding, -1)
    first_ids = (
        spark.read.schema(schemas.CHUNKS)
        .parquet(own_chunks)
        .withColumn("first_id", base + F.coalesce(F.sum("n").over(before), F.lit(0)) + 1)
        .drop("n", "file")
    )
    papers = rows.join(first_ids, ["partition", "task"])
    papers = papers.withColumn("id", F.col("first_id") + F.col("_place") - F.col("first_place"))
    (
        papers.select(*schemas.PAPERS.fieldNames())
        .sortWithinPartitions("partition", "id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .partitionBy("partition")
        .parquet(papers_path)
    )
    report = spark.createDataFrame([tuple(passed_over.get[n] for n in schemas.PASSED_OVER.fieldNames())], schemas.PASSED_OVER)
    report.write.mode("overwrite").parquet(f"{chunks_path}_passed_over/batch={batch_id}")


def landed_shards(spark: SparkSession, landing: str) -> DataFrame:
    """Names of the shard files in the landing folder; lists files without opening them."""
    listed = with_shard(spark.read.format("binaryFile").load(landing).select("*", "_metadata"))
    return listed.select("partition").distinct()


def shards_read(spark: SparkSession, chunks_path: str) -> DataFrame:
    """Names of the shards that were read: those of finished runs, also without a usable row, and those of finished batches.

    A batch is finished when its report, which is written last, is there.
    """
    finished = read_table_or_empty(spark, f"{chunks_path}_read", _READ)
    chunks = read_table_or_empty(spark, chunks_path, schemas.plus(schemas.CHUNKS, "batch", schemas.BIGINT))
    reports = read_table_or_empty(spark, f"{chunks_path}_passed_over", schemas.plus(schemas.PASSED_OVER, "batch", schemas.BIGINT))
    in_batches = chunks.join(reports.select("batch"), "batch", "left_semi").select("partition")
    return finished.unionByName(in_batches).distinct()


def passed_over(spark: SparkSession, chunks_path: str) -> DataFrame:
    """Number of records read and passed over, over all batches."""
    rows = read_table_or_empty(spark, f"{chunks_path}_passed_over", schemas.PASSED_OVER)
    return rows.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in schemas.PASSED_OVER.fieldNames()])


def ingest(
    spark: SparkSession,
    landing: str,
    papers_path: str,
    chunks_path: str,
    checkpoint: str,
    bytes_per_batch: int = BYTES_PER_BATCH,
) -> DataFrame:
    """Read every shard file not read before, then stop. A shard is one file, named after it.

    Returns the names of the shards that had landed before. A run that ends has read them all, and notes them as read.
    """
    landed = durable(landed_shards(spark, landing))
    query = (
        _shard_stream(spark, landing, bytes_per_batch)
        .writeStream.foreachBatch(lambda batch, batch_id: write_batch(batch, batch_id, papers_path, chunks_path))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    landed.write.mode("append").parquet(f"{chunks_path}_read")
    return landed
