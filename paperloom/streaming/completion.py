"""Completion as a stream: responses settle papers as they arrive, in any order and over any number of runs.

The stream keeps one state per paper id, the best outcome of all its responses so far. A state only moves forward: open (no
response, or ones that leave the paper open), error, done, and within done towards more values present. So a repeated or a
late response never takes anything back, and the outcome does not depend on the order of arrival or on the cut into batches.

Each batch notes the outcomes of the papers it met as one change set. A batch that is replayed overwrites its own. Readers
fold the change sets by the same rule; `compact` folds old ones into one, which changes no result.

State lives in the stream's checkpoint (RocksDB, so that it may exceed memory) and is one small row per paper ever met.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom import schemas
from paperloom.operators.complete import with_state
from paperloom.operators.worklist import VALUES, best_outcome
from paperloom.schemas import TODO
from paperloom.sources.readers import exists, finished_versions, read_table_or_empty
from paperloom.sources.writers import write_snapshot

# Bytes of response files per micro-batch; one file may be larger.
BYTES_PER_BATCH = 16 << 30
# Change sets that are read as they are; beyond it they are folded into one.
CHANGE_SETS = 50
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

OUTCOMES = schemas.only(schemas.WORKLIST, "id", *VALUES, "filled")
_CHANGES = schemas.plus(OUTCOMES, "batch", schemas.BIGINT)


def best_of(responses: DataFrame) -> DataFrame:
    """The best outcome of each paper; open ones are kept, as a stream's state has to know them."""
    outcome = best_outcome(F.col("state")).alias("o")
    return with_state(responses).groupBy("id").agg(outcome).select("id", *[f"o.{v}" for v in VALUES], "o.filled")


def _fold(outcomes: DataFrame) -> DataFrame:
    folded = outcomes.groupBy("id").agg(best_outcome(F.col("filled")).alias("o"))
    return folded.select("id", *[f"o.{v}" for v in VALUES], "o.filled")


def _changes(path: str) -> str:
    return f"{path}/changes"


def _folded(path: str) -> str:
    return f"{path}/folded"


def _parts(spark: SparkSession, path: str) -> tuple[DataFrame, int, DataFrame]:
    """The newest folded table, the last batch in it, and the change sets after that batch."""
    versions = finished_versions(spark, _folded(path))
    last = versions[-1] if versions else -1
    folded = read_table_or_empty(spark, f"{_folded(path)}/snapshot={last}", OUTCOMES)
    return folded, last, read_table_or_empty(spark, _changes(path), _CHANGES).filter(F.col("batch") > last)


def outcomes(spark: SparkSession, path: str) -> DataFrame:
    """id, values and state of every paper that a response has settled."""
    folded, _, changes = _parts(spark, path)
    return _fold(folded.unionByName(changes.drop("batch"))).filter(F.col("filled") != TODO)


def compact(spark: SparkSession, path: str) -> None:
    """Fold all change sets into one table. It counts once it is finished; the change sets in it are no longer read."""
    folded, last, changes = _parts(spark, path)
    upto = changes.agg(F.max("batch")).first()[0]
    if upto is not None and upto > last:
        write_snapshot(_fold(folded.unionByName(changes.drop("batch"))), f"{_folded(path)}/snapshot={upto}")


def settle(
    spark: SparkSession, responses_path: str, path: str, checkpoint: str, bytes_per_batch: int = BYTES_PER_BATCH,
    change_sets: int = CHANGE_SETS,
) -> None:
    """Take up every response file that was not read before, then stop."""
    spark.conf.set(STATE_STORE, ROCKSDB)
    responses = (
        spark.readStream.schema(schemas.RESPONSES).option("maxBytesPerTrigger", bytes_per_batch).option("maxFileAge", "100000d")
        .json(responses_path)
    )

    def note(batch: DataFrame, batch_id: int) -> None:
        batch.select(*OUTCOMES.fieldNames()).write.mode("overwrite").parquet(f"{_changes(path)}/batch={batch_id}")

    query = (
        best_of(responses)
        .writeStream.outputMode("update")
        .foreachBatch(note)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if exists(spark, _changes(path)):
        _, _, changes = _parts(spark, path)
        if changes.select("batch").distinct().count() > change_sets:
            compact(spark, path)


def staged(main: DataFrame, settled: DataFrame) -> DataFrame:
    """Settled papers as staging rows: those of the work-list, with its partition."""
    return settled.join(main.select("id", "partition"), "id").select(*schemas.WORKLIST.fieldNames())
