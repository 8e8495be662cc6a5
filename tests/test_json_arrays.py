"""JSON arrays in every layout and with splits at every place, against Python's own reader."""

import json
import random

import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql.types import StructField, StructType

from paperloom import schemas
from paperloom.sources import json_arrays, readers, writers

KEYS = ("id", "title", "abstract", "report-no")


def _objects(n, seed=1):
    rng = random.Random(seed)
    parts = ['"', "\\", "{", "}", "[", "]", ",", "\n", "é", "漢", " ", "a", '\\"', "}{", "\t"]
    text = lambda: "".join(rng.choice(parts) for _ in range(rng.randrange(12)))
    out = []
    for i in range(n):
        o = {"id": str(i), "title": text(), "abstract": text(), "authors_parsed": [[text(), text()]] * rng.randrange(3)}
        if rng.random() < 0.3:
            o["extra"] = {"deep": [{"er": text()}, {}], "n": 1}
        if rng.random() < 0.3:
            del o["title"]
        out.append(o)
    return out


def _texts(objects):
    return {
        "one line": json.dumps(objects, ensure_ascii=False),
        "narrow": json.dumps(objects, separators=(",", ":")),
        "pretty": json.dumps(objects, indent=4, ensure_ascii=False) + "\n",
        "lines": "[\n" + ",\n".join(map(json.dumps, objects)) + "\n]",
        "odd": " \n[" + " \n,\r\n ".join(map(json.dumps, objects)) + "\t ]\n\n ",
    }


@pytest.fixture
def split(spark):
    """Sets the size of splits."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def to(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield to
    for key, value in before.items():
        spark.conf.set(key, value)


def _read(spark, path, **options):
    rows = readers.read_json_array(spark, str(path), **options).collect()
    return sorted((int(r.id), r.title, r.abstract, json.dumps(r.authors_parsed)) for r in rows)


def _expected(objects):
    return sorted((int(o["id"]), o.get("title"), o.get("abstract"), json.dumps(o["authors_parsed"])) for o in objects)


@pytest.mark.parametrize("layout", ["one line", "narrow", "pretty", "lines", "odd"])
def test_every_layout_in_small_splits(spark, tmp_path, split, layout):
    objects = _objects(60)
    text = _texts(objects)[layout]
    assert json.loads(text) == objects
    (tmp_path / "a.json").write_text(text, encoding="utf-8")
    for size in (10_000_000, 97):
        split(size)
        assert _read(spark, tmp_path / "a.json") == _expected(objects), size


def test_splits_within_every_kind_of_place(spark, tmp_path, split):
    objects = _objects(4, seed=7)
    (tmp_path / "a.json").write_text(json.dumps(objects), encoding="utf-8")
    for size in (11, 26, 53):
        split(size)
        assert _read(spark, tmp_path / "a.json") == _expected(objects), size


def test_several_files_and_the_path_for_very_many_splits(spark, tmp_path, split):
    objects = _objects(50, seed=3)
    for n, (layout, text) in enumerate(_texts(objects[:40]).items()):
        (tmp_path / f"{n} {layout}.json").write_text(text, encoding="utf-8")
    (tmp_path / "empty.json").write_text(" [ \n ] ")
    (tmp_path / "one.json").write_text(json.dumps(objects[40:]))
    split(150)
    expected = sorted(_expected(objects[:40]) * 5 + _expected(objects[40:]))
    assert _read(spark, tmp_path) == expected
    assert _read(spark, tmp_path, broadcast_blocks=0) == expected


@pytest.mark.parametrize(
    "text",
    [
        '{"id": "1"}', '{"id": "1"}\n{"id": "2"}\n', '[{"id": "1"}', '[{"id": "1"}, {"id": "2"', '[{"id": "1"}, 5, {"id": "2"}]', "[1, 2]", '["a}"]',
        '[[{"id": "1"}], {"id": "2"}]', '[{"id": "1"} {"id": "2"}]', '[{"id": "1",}]', '[{"id": "1"}] x', "   ", '[{"id": "1"}, null]', '[{"id": "1"},]',
    ],
)
def test_what_is_no_array_of_objects_is_an_error(spark, tmp_path, split, text):
    (tmp_path / "a.json").write_text(text)
    split(8)
    with pytest.raises((ValueError, PySparkException)):
        readers.read_json_array(spark, str(tmp_path / "a.json")).collect()


def test_a_value_of_another_type_is_an_error(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"n": 1}, {"n": "x"}]')
    with pytest.raises(PySparkException, match="does not fit"):
        readers.read_json_array(spark, str(tmp_path / "a.json"), StructType([StructField("n", schemas.INT)])).collect()


def test_only_needed_splits_are_joined(spark, tmp_path, split):
    """Records within a split are not shuffled: the pieces at borders are few."""
    (tmp_path / "a.json").write_text(json.dumps(_objects(400)))
    split(8000)
    cuts = json_arrays._cuts(spark, str(tmp_path), 1000)
    kinds = {r.kind: r["count"] for r in cuts.groupBy("kind").count().collect()}
    blocks = cuts.select("block").distinct().count()
    assert kinds[json_arrays.REST] == 1 and 0 < kinds[json_arrays.PIECE] <= 2 * blocks and blocks >= 7 and kinds[json_arrays.WHOLE] > 200


def test_long_records_are_handed_on_in_small_parts():
    """However many rows Spark sends at once, few of them are Python's texts at a time, and none is lost."""
    texts = [f'{"[" if i == 0 else ","} {{"id": "{i}", "title": "{"x" * 20_000}"' for i in range(1_000)]
    n = len(texts)
    columns = [[*texts, " ]"], *([v] * (n + 1) for v in (7, 0, 0, 0, 0, True))]
    names = ["value", "file_no", "block", "inside", "depth", "record_no", "last"]
    out = list(json_arrays._cut(iter([pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)])))
    assert max(batch.nbytes for batch in out) < 2 * json_arrays.HANDED_ON and len(out) > 5
    rows = [row for batch in out for row in batch.to_pylist()]
    assert [r["record_no"] for r in rows] == [*range(n), n] and [r["kind"] for r in rows] == [json_arrays.WHOLE] * n + [json_arrays.REST]
    assert json.loads("".join(r["text"] for r in rows))[-1]["id"] == str(n - 1)


@pytest.mark.parametrize("layout", writers.LAYOUTS)
def test_written_arrays_are_read_by_any_reader(spark, tmp_path, layout):
    rows = [(str(i), f't"{i}\n', None, "r", [["a", "b"]]) for i in range(25)]
    papers = spark.createDataFrame(rows, schemas.CATEGORY_PAPERS)
    writers.write_json_arrays(papers, str(tmp_path / "out"), layout=layout, rows_per_file=10)
    files = sorted((tmp_path / "out").rglob("part-*"))
    assert len(files) == 3
    arrays = [json.loads(f.read_text()) for f in files]
    assert sorted(int(o["id"]) for a in arrays for o in a) == list(range(25)) and all("abstract" not in o for a in arrays for o in a)
    assert (max(f.read_text().count("\n") for f in files) == 0) == (layout == "one line")
    assert sorted(map(tuple, readers.read_json_array(spark, str(tmp_path / "out")).collect())) == sorted(rows)
    writers.write_json_arrays(papers.limit(0), str(tmp_path / "none"), layout=layout)
    assert readers.read_json_array(spark, str(tmp_path / "none")).collect() == []
