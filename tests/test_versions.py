"""Tables as a base and change sets: what is read, what is written, and what a job that breaks off leaves."""

from pathlib import Path

import pytest

from paperloom import schemas
from paperloom.operators import worklist
from paperloom.sources import versions, writers

S = schemas.WORKLIST


def _rows(spark, rows):
    return spark.createDataFrame(rows, S)


def _state(spark, path):
    table, number = versions.read_version(spark, path, S)
    return sorted(map(tuple, table.collect())), number


BASE = [(f"p{i}", None, None, None, i % 3, 0) for i in range(6)]


def test_changes_are_laid_over_the_base(spark, tmp_path):
    path = str(tmp_path / "t")
    assert _state(spark, path) == ([], -1)
    versions.commit_changes(_rows(spark, BASE), path, -1, S)
    versions.commit_changes(_rows(spark, [("p1", "V", 2000, 1, 1, 1), ("new", None, None, None, None, 0)]), path, 0, S)
    versions.commit_changes(_rows(spark, [("p1", None, None, None, 1, 2)]), path, 1, S)
    versions.commit_changes(_rows(spark, []), path, 2, S)
    rows, number = _state(spark, path)
    expected = [*(r for r in BASE if r[0] != "p1"), ("p1", None, None, None, 1, 2), ("new", None, None, None, None, 0)]
    assert number == 3 and rows == sorted(expected)
    # A new base gives the same, under the number of the last change; later changes go on from it.
    versions.commit_changes(_rows(spark, []), path, 3, S, most_changes=3)
    assert _state(spark, path) == (rows, 4) and (tmp_path / "t" / "snapshot=4").is_dir()
    versions.commit_changes(_rows(spark, [("p0", "W", None, None, 0, 1)]), path, 4, S)
    assert _state(spark, path)[1] == 5 and ("p0", "W", None, None, 0, 1) in _state(spark, path)[0]


@pytest.mark.parametrize("at", ["change=1", "snapshot=1"])
def test_a_job_that_breaks_off_leaves_the_old_state(spark, tmp_path, at):
    path = str(tmp_path / "t")
    versions.commit_changes(_rows(spark, BASE), path, -1, S, most_changes=0)
    before = _state(spark, path)
    versions.commit_changes(_rows(spark, [("p1", "V", 2000, 1, 1, 1)]), path, 0, S, most_changes=0 if at.startswith("s") else 9)
    after = _state(spark, path)
    (tmp_path / "t" / at / "_SUCCESS").unlink()
    if at == "change=1":  # the change isn't there; the next job writes it again
        assert _state(spark, path) == before
        versions.commit_changes(_rows(spark, [("p2", "X", 1, 1, 2, 1)]), path, 0, S)
        assert _state(spark, path)[0] == sorted([*(r for r in BASE if r[0] != "p2"), ("p2", "X", 1, 1, 2, 1)])
    else:  # the new base isn't there; the old one and the change are
        assert _state(spark, path) == after


def test_written_rows_follow_the_change(spark, tmp_path):
    path = str(tmp_path / "t")
    big = [(f"p{i}", None, None, None, i % 3, 0) for i in range(20_000)]
    versions.commit_changes(_rows(spark, big), path, -1, S)
    main, number = versions.read_version(spark, path, S)
    staging = _rows(spark, [("p7", "V", 2000, 1, 1, 1), ("p8", None, None, None, 2, 0), ("foreign", "V", 1, 1, 0, 1)])
    versions.commit_changes(worklist.merged_rows(main, staging), path, number, S)
    size = lambda n: sum(f.stat().st_size for f in (Path(path) / f"change={n}").glob("part-*"))
    assert spark.read.parquet(f"{path}/change=1").count() <= 2 and size(1) < size(0) / 5
    merged, number = versions.read_version(spark, path, S)
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, worklist.merge_staging(main, staging).collect()))
    reset = worklist.reset_rows(merged, 0)
    assert [r.id for r in reset.collect()] == ["p7"]
    versions.commit_changes(reset, path, number, S)
    assert sorted(map(tuple, versions.read_version(spark, path, S)[0].collect())) == sorted(map(tuple, worklist.reset_outside(merged, 0).collect()))


def test_changed_rows(spark):
    before = spark.createDataFrame([("a", 0), ("b", 1), ("c", None)], schemas.CHECKLIST)
    after = spark.createDataFrame([("a", 1), ("b", 1), ("c", None), ("d", 0)], schemas.CHECKLIST)
    assert sorted(map(tuple, versions.changed_rows(after, before).collect())) == [("a", 1), ("d", 0)]


def test_snapshots_of_earlier_versions_are_a_base(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_snapshot(_rows(spark, BASE), f"{path}/snapshot=4")
    assert _state(spark, path) == (sorted(BASE), 4)
