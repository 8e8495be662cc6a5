"""Tables dealt out by a key: joins leave them where they are, and any session can open them."""

import pytest
from pyspark.sql import functions as F

from paperloom import schemas
from paperloom.operators import complete, export, worklist
from paperloom.sources import buckets


def _plan(frame):
    """The plan before the run, without what adaptive execution repeats."""
    return frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def _exchanges_above(plan, scan):
    """Exchanges between a scan and the join above it."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if scan in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    found, level = 0, depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < level:
            level = depth(line)
            if "Join" in line:
                return found
            found += "Exchange" in line
    raise AssertionError("no join")


@pytest.fixture(scope="module")
def main(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("buckets") / "work list")
    rows = spark.range(3_000).selectExpr(
        "cast(id AS string) AS id", "cast(NULL AS string) AS venue", "cast(NULL AS int) AS year", "cast(NULL AS int) AS n_citations",
        "cast(id % 3 AS int) AS partition", "cast(id % 2 AS int) AS filled",
    )
    buckets.write_bucketed(rows, path, "id", buckets.buckets_for(spark, 3_000))
    return rows, path


def test_ids_are_looked_up_in_place(spark, main):
    rows, path = main
    ids = spark.range(0, 4_000, 5).selectExpr("cast(id AS string) AS id")
    ids = ids.unionByName(ids)
    table = buckets.read_bucketed(spark, path)
    found = buckets.by_ids_in_place(table, ids)
    plan = _plan(found)
    assert "Bucketed: true" in plan and _exchanges_above(plan, "Bucketed: true") == 0
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, export.by_ids(rows, ids).collect()))
    assert buckets.by_ids_in_place(table, ids.limit(0)).count() == 0


def test_merge_and_completion_in_place(spark, main):
    rows, path = main
    staging = spark.range(0, 500).selectExpr("cast(id AS string) AS id", "'V' AS venue", "2000 AS year", "1 AS n_citations", "0 AS partition", "1 AS filled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table = buckets.read_bucketed(spark, path)
        merged = worklist.merge_staging(table, staging)
        assert _exchanges_above(_plan(merged), "Bucketed: true") == 0
        assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, worklist.merge_staging(rows, staging).collect()))
        # Two tables dealt out into as many buckets are joined without any exchange.
        raw = rows.selectExpr("id", "array(array(id, 'x')) AS authors_parsed")
        buckets.write_bucketed(raw, f"{path} raw", "id", buckets.buckets_for(spark, 3_000))
        joined = complete.completed_papers(buckets.read_bucketed(spark, f"{path} raw"), table)
        assert "Exchange" not in _plan(joined) and joined.count() == 1_500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_another_session_opens_the_table(spark, main):
    rows, path = main
    spark.sql(f"DROP TABLE {buckets._name(path)}")
    table = buckets.read_bucketed(spark, path)
    assert table.count() == 3_000 and table.dtypes == rows.dtypes
    assert "Bucketed: true" in _plan(buckets.by_ids_in_place(table, rows.select("id")))
    with pytest.raises(FileNotFoundError):
        buckets.read_bucketed(spark, path + " none")


def test_a_table_is_written_anew(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (10, 20):
        buckets.write_bucketed(spark.range(n).withColumn("t", F.lit("x")), path, "id", 4)
        assert buckets.read_bucketed(spark, path).count() == n
    buckets.write_bucketed(spark.createDataFrame([], schemas.CHECKLIST), path, "partition", 4)
    assert buckets.read_bucketed(spark, path).columns == ["partition", "is_checked"]
