"""Reading the given tables and running a per-text function over Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(frame: DataFrame, stem: str) -> str:
    """A column name that the frame does not have (names are compared without case)."""
    taken = {c.lower() for c in frame.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator needs, under fixed names, so that no other column can clash."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def map_texts(frame: DataFrame, start: Callable[[], Callable], schema: str) -> DataFrame:
    """Map the rows of `frame` (doc_id, text) to rows of `schema`, whose first column is doc_id.

    `start` runs once per task and returns a function from a text (None for null) to the values of the other
    columns. Rows are worked on one at a time, so a task holds one Arrow batch and its results.
    """
    width = len(schema.split(",")) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        kinds = None
        for batch in batches:
            columns = [[] for _ in range(width)]
            texts = batch.column(1)
            for i in range(batch.num_rows):
                for column, value in zip(columns, work(texts[i].as_py()), strict=True):
                    column.append(value)
            kinds = kinds or arrow_schema(schema)
            arrays = [pa.array(values, kind.type) for values, kind in zip(columns, list(kinds)[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], schema=kinds)

    return frame.mapInArrow(run, schema)


ARROW_TYPES = {
    "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(),
    "binary": pa.binary(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64()),
    "array<double>": pa.list_(pa.float64()), "array<string>": pa.list_(pa.string()),
}


def arrow_schema(schema: str) -> pa.Schema:
    """Arrow schema of a flat DDL string."""
    return pa.schema([(name, ARROW_TYPES[kind]) for name, kind in (part.split() for part in schema.split(","))])
