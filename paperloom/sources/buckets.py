"""Tables dealt out by a key when they are written, so that joins on the key leave them where they are.

A table that is merged into, joined or exported by id again and again (papers, the work-list) is shuffled once, at writing:
bucket i of n holds the rows whose key hashes to i, sorted by it. A join on the key then reads bucket by bucket; only
the other side is shuffled, and nothing at all if that is dealt out into as many buckets.

The files are an ordinary Parquet folder. What a session has to know beside them (key and number of buckets) is kept in a
small file beside the folder and given to the session's catalog when the table is opened.
"""

from __future__ import annotations

import re
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from paperloom import schemas
from paperloom.sources.readers import exists

_FACTS = StructType([StructField("key", schemas.TEXT), StructField("buckets", schemas.INT), StructField("ddl", schemas.TEXT)])


def _facts(path: str) -> str:
    return f"{path.rstrip('/')}.buckets"


def _name(path: str) -> str:
    """A table name of the path: its last part, to be read, and a checksum."""
    last = re.sub(r"\W", "_", path.rstrip("/").rpartition("/")[2]).lower()
    return f"paperloom_{last}_{zlib.crc32(path.encode()):08x}"


def buckets_for(spark: SparkSession, rows: int, rows_per_bucket: int = 1_000_000) -> int:
    """Enough buckets for the rows, and no fewer than the session's shuffles have: the planner would else deal out anew."""
    return max(-(-rows // rows_per_bucket), int(spark.conf.get("spark.sql.shuffle.partitions")))


def write_bucketed(rows: DataFrame, path: str, key: str, buckets: int) -> None:
    """Write a table dealt out by `key`. The path must not be one the plan reads."""
    spark, name = rows.sparkSession, _name(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    # repartition() deals rows out by the hash that buckets use, so each task writes the file of one bucket.
    dealt = rows.repartition(buckets, key).write.mode("overwrite").format("parquet").option("path", path)
    dealt.bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    spark.createDataFrame([(key, buckets, ddl)], _FACTS).write.mode("overwrite").json(_facts(path))


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """Open a table that any session has written."""
    name = _name(path)
    if not spark.catalog.tableExists(name):
        if not exists(spark, _facts(path)):
            raise FileNotFoundError(f"no table dealt out by a key at {path}")
        facts = spark.read.schema(_FACTS).json(_facts(path)).first()
        spark.sql(
            f"CREATE TABLE {name} ({facts.ddl}) USING parquet CLUSTERED BY (`{facts.key}`) SORTED BY (`{facts.key}`)"
            f" INTO {facts.buckets} BUCKETS LOCATION '{path}'"
        )
    return spark.table(name)


def by_ids_in_place(table: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """The rows of a table dealt out by `key` whose key is listed; only the distinct ids are shuffled."""
    wanted = ids.select(F.col(key)).distinct()
    return table.join(wanted.hint("merge"), key, "left_semi")
