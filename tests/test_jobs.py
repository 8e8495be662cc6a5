"""Jobs end to end on files: topic work-list, corpus ingestion and matching, exports, variants, masks."""

import gzip
import json
import os
import random
import time
from collections import Counter
from pathlib import Path

import pytest

from paperloom import schemas
from paperloom.__main__ import run
from paperloom.operators import variant
from paperloom.operators.mask import MASKS
from paperloom.plans import commands as jobs
from paperloom.sources import readers, writers
from paperloom.streaming import ingest as stream


def _lines(path):
    return [line for file in sorted(Path(path).rglob("part-*")) for line in file.read_text().splitlines()]


def _records(path):
    return [json.loads(line) for line in _lines(path)]


def _snapshot_record(i, title, categories, **more):
    base = dict.fromkeys(("doi", "submitter", "comments", "authors", "license", "journal-ref", "report-no"))
    return {
        **base, "id": f"07{i:02d}", "title": title, "categories": categories, "abstract": f"about {title}",
        "versions": [{"version": "v1", "created": "x"}], "update_date": "2020-01-01",
        "authors_parsed": [["Doe", "Jane", ""], ["Roe", "Rick", ""]], **more,
    }


SNAPSHOT = [
    _snapshot_record(1, "Machine learning one", "cs.LG stat.ML"),
    _snapshot_record(2, "MACHINE-LEARNING two", "cs.AI cs.LG", **{"report-no": "R2"}),
    _snapshot_record(3, "Plasma machine learning", "physics.plasm-ph"),
    _snapshot_record(4, "Databases", "cs.DB"),
    _snapshot_record(5, "Machine Learning: one!", "cs.LG"),
]


@pytest.fixture()
def layout(tmp_path):
    layout = jobs.Layout(str(tmp_path / "base"))
    folder = Path(layout.snapshot)
    folder.mkdir(parents=True)
    (folder / "snapshot.json").write_text("\n".join(json.dumps(r) for r in SNAPSHOT))
    return layout


def _shard(layout, name, titles, fields=("Computer Science",), venue="V"):
    folder = Path(layout.landing)
    folder.mkdir(parents=True, exist_ok=True)
    rows = [
        {
            "id": f"{name}-{i}", "title": t, "paperAbstract": f"machine learning {t}", "authors": [{"name": "A B"}],
            "inCitations": ["x"] * i, "outCitations": [], "fieldsOfStudy": list(fields), "venue": venue, "year": 2000 + i,
            "doi": "d",
        }
        for i, t in enumerate(titles)
    ]
    with gzip.open(folder / f"{name}.gz", "wt") as f:
        f.write("\n".join(json.dumps(r) for r in rows))


def test_topic_worklist_completion_export(spark, layout):
    report = jobs.extract_topic(spark, layout, "cs", "ml", seed=1, store=True)
    assert tuple(report.first()) == (3, 4, 3)
    ids = spark.read.parquet(layout.export("ids_cs_ml"))
    assert sorted(r.id for r in ids.collect()) == ["0701", "0702", "0705"]
    assert tuple(jobs.topic_count(spark, layout, "cs", "ml").first()) == (3, 4)
    kept = {frozenset(r) for r in _records(layout.category("cs"))}
    assert kept == {
        frozenset({"id", "title", "abstract", "authors_parsed"}),
        frozenset({"id", "title", "abstract", "authors_parsed", "report-no"}),
    }
    status = jobs.fill_status(spark, layout, "cs_ml", -1).first()
    assert (status.filled, status.error, status.total, status.unfilled) == (0, 0, 3, 3)

    folder = Path(layout.responses("cs_ml"))
    folder.mkdir(parents=True)

    def respond(name, *answers):
        lines = [json.dumps({"id": i, "status": s, "body": json.dumps(b)}) for i, s, b in answers]
        (folder / name).write_text("\n".join(lines))

    good = {"venue": "ICML", "year": 2019, "citationCount": 4}
    respond("one.json", ("0701", 200, good), ("0702", 403, {"message": "Forbidden"}), ("0705", 404, {"error": "no"}))
    jobs.fill_data(spark, layout, "cs_ml", -1)
    jobs.fill_data(spark, layout, "cs_ml", -1)
    staged = spark.read.parquet(layout.staging("cs_ml"))
    assert sorted((r.id, r.filled) for r in staged.collect()) == [("0701", 1), ("0705", 2)]
    respond("two.json", ("0702", 200, {**good, "venue": None}))
    jobs.fill_data(spark, layout, "cs_ml", -1)
    status = jobs.fill_status(spark, layout, "cs_ml", -1).first()
    assert (status.filled, status.error, status.total, status.unfilled, status.pending_net) == (2, 1, 3, 3, 0)

    assert jobs.merge_data(spark, layout, "cs_ml").first()[0] == 3
    status = jobs.fill_status(spark, layout, "cs_ml", -1).first()
    assert (status.filled, status.error, status.total, status.unfilled) == (2, 1, 3, 0)
    jobs.export_data(spark, layout, "cs_ml")
    done = {r["id"]: r for r in _records(layout.export("completed_cs_ml.data"))}
    assert set(done) == {"0701", "0702"}
    assert done["0701"]["authors"] == ["Jane Doe", "Rick Roe"] and done["0701"]["n_citations"] == 4
    assert done["0702"]["venue"] is None and done["0702"]["report-no"] == "R2"

    masks = jobs.make_masks(spark, layout, layout.export("completed_cs_ml.data"))
    by_mask = Counter(p.parent.name for p in Path(masks).rglob("part-*") for _ in p.read_text().splitlines())
    assert by_mask == {f"masking={m}": 2 for m in MASKS}

    main, _ = jobs.latest(spark, layout.worklist("cs_ml"), schemas.WORKLIST)
    keep = main.filter("id = '0701'").first().partition
    jobs.clear_partition(spark, layout, "cs_ml", keep)
    main, version = jobs.latest(spark, layout.worklist("cs_ml"), schemas.WORKLIST)
    assert version == 2 and main.filter(f"partition <> {keep} AND filled <> 0").count() == 0
    assert main.filter("id = '0701'").first().venue == "ICML"


def test_storing_a_topic_twice_changes_nothing(spark, layout):
    for _ in range(2):
        jobs.extract_topic(spark, layout, "cs", "ml", seed=1, store=True)
    main, version = jobs.latest(spark, layout.worklist("cs_ml"), schemas.WORKLIST)
    assert version == 1 and main.count() == main.select("id").distinct().count() == 3


def test_corpus(spark, layout, tmp_path):
    Path(layout.manifest).mkdir()
    (Path(layout.manifest) / "manifest.txt").write_text("s2-000.gz\ns2-001.gz\ns2-002.gz\ns2-009.gz\n")
    jobs.init_corpus(spark, layout)
    _shard(layout, "s2-000", ["Machine Learning One", "Else", "machine learning one"])
    _shard(layout, "s2-001", ["Physics"], fields=("Physics",))
    jobs.ingest_corpus(spark, layout)
    first = {r.s2_id: r.id for r in readers.read_papers(spark, layout.papers).collect()}
    assert sorted(first.values()) == [1, 2, 3]

    jobs.ingest_corpus(spark, layout)
    assert {r.s2_id: r.id for r in readers.read_papers(spark, layout.papers).collect()} == first
    _shard(layout, "s2-002", ["Databases", "Machine-learning TWO"])
    jobs.ingest_corpus(spark, layout)
    second = {r.s2_id: r.id for r in readers.read_papers(spark, layout.papers).collect()}
    assert first.items() <= second.items() and sorted(second.values()) == [1, 2, 3, 4, 5]
    checklist, _ = jobs.latest(spark, layout.checklist, schemas.CHECKLIST)
    assert {r.partition: r.is_checked for r in checklist.collect()} == {
        "s2-000": 1, "s2-001": 1, "s2-002": 1, "s2-009": 0,
    }
    assert jobs.corpus_count(spark, layout).first()[0] == 5
    assert jobs.corpus_topic_count(spark, layout, "ml").first()[0] == 5
    assert jobs.index_topics(spark, layout).first().shards == 2
    assert jobs.corpus_topic_count(spark, layout, "ml").first()[0] == 5
    assert jobs.index_topics(spark, layout).first().shards == 2

    rate = jobs.match_label(spark, layout, "cslg").first()
    assert (rate.n_keys, rate.n_matches, rate.rate) == (2, 3, 150.0)
    audit = {r["id"]: r for r in _records(layout.audit("cslg"))}
    assert audit[second["s2-000-0"]]["a_title"] == "Machine Learning: one!"
    jobs.match_label(spark, layout, "csdb")
    jobs.match_label(spark, layout, "cscv")
    listed = jobs.label_counts(spark, layout).collect()
    assert (listed[0]["cate"], listed[0]["total"], listed[0]["labels"]) == ("cslg", 4, 40)
    found = {r["cate"]: r["count"] for r in listed}
    assert (found["cslg"], found["csdb"], found["cscv"], len(found)) == (3, 1, 0, 40)

    one_by_one = {(r.cate, r.id) for r in spark.read.parquet(layout.index).collect()}
    rates = {r.cate: r.rate for r in jobs.match_labels(spark, layout).collect()}
    assert len(rates) == 40
    assert {c: r for c, r in rates.items() if r is not None} == {"cslg": 150.0, "csai": 100.0, "csdb": 100.0}
    at_once = {(r.cate, r.id) for r in spark.read.parquet(layout.index).collect()}
    assert one_by_one <= at_once and {c for c, _ in at_once - one_by_one} == {"csai"}

    label = _records(jobs.export_label(spark, layout, "cslg"))
    assert {r["s2_id"] for r in label} == {"s2-000-0", "s2-000-2", "s2-002-1"}
    assert list(label[0]) == schemas.PAPER_RECORD.fieldNames() and label[0]["authors"] == ["A B"]
    sampled = jobs.export_label(spark, layout, "cslg", amount=2, seed=3)
    assert "_rand_2_0x" in sampled and len(_records(sampled)) == 2
    assert jobs.export_label(spark, layout, "cslg", amount=3).endswith("_all_.data")
    assert sorted(r["id"] for r in _records(jobs.export_range(spark, layout, 2, 3))) == [2, 3, 4]
    assert len(_records(jobs.export_random(spark, layout, seed=1))) == 5
    ids = tmp_path / "ids.txt"
    ids.write_text("5\n5\n\n 1 \n77")
    assert sorted(r["id"] for r in _records(jobs.export_from_ids(spark, layout, str(ids)))) == [1, 5]

    seeds = tmp_path / "seeds"
    seeds.write_text(json.dumps(label[0]))
    source = layout.export("completed_s2_arxiv_cslg_all_.data")
    variants = jobs.make_variants(spark, layout, str(seeds), source)
    counted = Counter(p.parent.name for p in Path(variants).rglob("part-*") for _ in p.read_text().splitlines())
    text_features = {f"feature={f}": 3 for f in ("title", "abstract", "venue", "authors")}
    assert counted == {**text_features, "feature=year": 2_050, "feature=citation": 10_000}
    masks = _records(jobs.make_masks(spark, layout, source))
    assert len(masks) == 21 and all("s2_id" in r and "id" not in r for r in masks)
    assert (Path(variants) / f"seed_id={label[0]['id']}" / "source=cslg").is_dir()


def test_replayed_batch(spark, layout):
    """A batch that runs again after a crash leaves the same rows with the same ids."""
    _shard(layout, "s2-000", ["one", "two", "three"])
    _shard(layout, "s2-001", ["four", "five"])
    for _ in range(2):
        for batch_id, name in enumerate(("s2-000", "s2-001")):
            batch = readers.read_shards(spark, f"{layout.landing}/{name}.gz")
            stream.write_batch(batch, batch_id, layout.papers, layout.chunks)
        got = {r.title: r.id for r in readers.read_papers(spark, layout.papers).collect()}
        assert got == {"one": 1, "two": 2, "three": 3, "four": 4, "five": 5}
    shards = readers.read_papers(spark, layout.papers, columns=["title"], shards=["s2-001"])
    assert sorted(r.title for r in shards.collect()) == ["five", "four"]


def test_batches_are_bounded_in_bytes(spark, layout):
    """Small shards share a batch, a shard beyond the bound has one of its own, and ids do not depend on the batches."""
    rng = random.Random(1)
    sizes = {}
    for n, rows in enumerate([1, 2, 300, 3, 4, 5]):
        _shard(layout, f"s2-00{n}", [f"title {n} {i} {rng.random()}" for i in range(rows)])
        sizes[f"s2-00{n}"] = (Path(layout.landing) / f"s2-00{n}.gz").stat().st_size
        _set_age(layout, f"s2-00{n}.gz", 10 - n)
    bound = 2 * sizes["s2-000"] + 200
    assert sizes["s2-002"] > bound
    landed = stream.ingest(spark, layout.landing, layout.papers, layout.chunks, layout.ingest_checkpoint, bytes_per_batch=bound)
    assert landed.count() == 6 and stream.shards_read(spark, layout.chunks).count() == 6
    assert sorted(r.id for r in readers.read_papers(spark, layout.papers).collect()) == list(range(1, 316))
    batches = {}
    for r in spark.read.parquet(layout.chunks).select("batch", "partition").distinct().collect():
        batches.setdefault(r.batch, []).append(sizes[r.partition])
    assert 3 <= len(batches) < 6
    assert all(len(own) == 1 or sum(own) <= bound for own in batches.values())


def test_a_batch_that_failed_does_not_count_as_read(spark, layout):
    _shard(layout, "d", ["one"])
    jobs.ingest_corpus(spark, layout)
    _shard(layout, "d.json", ["two"])
    _shard(layout, "e", ["three"])
    with pytest.raises(Exception, match="two files make the shard 'd'"):
        jobs.ingest_corpus(spark, layout)
    assert [r.partition for r in stream.shards_read(spark, layout.chunks).collect()] == ["d"]


def test_rows_of_one_large_shard_are_staged_in_several_files(spark, layout, monkeypatch):
    monkeypatch.setattr(stream, "ROWS_PER_STAGED_FILE", 20)
    _shard(layout, "s2-000", [f"title {i}" for i in range(90)])
    jobs.ingest_corpus(spark, layout)
    assert len(list(Path(layout.chunks + "_staged").glob("part-*"))) == 5
    assert sorted(r.id for r in readers.read_papers(spark, layout.papers).collect()) == list(range(1, 91))


def _set_age(layout, name, days):
    path = Path(layout.landing) / name
    os.utime(path, (time.time() - days * 86_400,) * 2)


def test_old_shards_odd_names_and_unread_ones(spark, layout):
    """Shards that landed late with an old time stamp or a name that is encoded in paths are read, counted and checked."""
    _shard(layout, "s2-000", ["Databases"])
    jobs.ingest_corpus(spark, layout)
    _shard(layout, "s-old", ["machine learning one"])
    _set_age(layout, "s-old.gz", 30)
    _shard(layout, "sp ace+x%41", ["machine learning two"])
    _shard(layout, "nothing", [], fields=())
    with gzip.open(Path(layout.landing) / "broken.json.gz", "wt") as f:
        f.write('{"id": "b", "title"\n')
    report = jobs.ingest_corpus(spark, layout).first()
    assert (report.shards_landed, report.shards_read, report.shards_unread) == (5, 5, 0)
    assert (report.total, report.unparsable) == (4, 1)
    papers = readers.read_papers(spark, layout.papers).collect()
    assert {r.partition for r in papers} == {"s2-000", "s-old", "sp ace+x%41"} and sorted(r.id for r in papers) == [1, 2, 3]
    checklist, _ = jobs.latest(spark, layout.checklist, schemas.CHECKLIST)
    names = {"s2-000", "s-old", "sp ace+x%41", "nothing", "broken"}
    assert {r.partition: r.is_checked for r in checklist.collect()} == dict.fromkeys(names, 1)
    assert jobs.corpus_topic_count(spark, layout, "ml").first()[0] == 3


def test_names_with_one_prefix_stay_apart(spark, layout):
    _shard(layout, "d.1", ["one"])
    jobs.ingest_corpus(spark, layout)
    _shard(layout, "d.2", ["two"])
    jobs.ingest_corpus(spark, layout)
    got = {r.title: (r.id, r.partition) for r in readers.read_papers(spark, layout.papers).collect()}
    assert got == {"one": (1, "d.1"), "two": (2, "d.2")}


def test_two_files_of_one_shard_name_fail_the_batch(spark, layout):
    _shard(layout, "d", ["one"])
    jobs.ingest_corpus(spark, layout)
    _shard(layout, "d.json", ["two"])
    with pytest.raises(Exception, match="two files make the shard 'd'"):
        jobs.ingest_corpus(spark, layout)
    assert [r.title for r in readers.read_papers(spark, layout.papers).collect()] == ["one"]


def test_a_broken_off_snapshot_does_not_count(spark, layout):
    rows = spark.createDataFrame([("a", 0)], schemas.CHECKLIST)
    writers.write_snapshot(rows, f"{layout.checklist}/snapshot=0")
    writers.write_snapshot(rows.selectExpr("partition", "1 AS is_checked"), f"{layout.checklist}/snapshot=1")
    (Path(layout.checklist) / "snapshot=1" / "_SUCCESS").unlink()
    table, version = jobs.latest(spark, layout.checklist, schemas.CHECKLIST)
    assert version == 0 and table.first().is_checked == 0


def test_further_keys_pass_through(spark, layout, tmp_path):
    """A key that no schema names stays with a snapshot paper and with a seed; a completed paper gets no foreign key."""
    record = json.dumps({**SNAPSHOT[0], "id": "0799", "extra": {"a": [1]}})
    (Path(layout.snapshot) / "more.json").write_text(record)
    jobs.extract_category(spark, layout, "cs")
    kept = {r["id"]: r for r in _records(layout.category("cs"))}
    assert kept["0799"]["extra"] == {"a": [1]} and "extra" not in kept["0701"]
    seed = {"id": 1, "s2_id": "x", "title": "t", "abstract": "a", "venue": "v", "authors": ["A"], "year": 1, "n_citations": 2}
    for name, more in (("seeds", {"report-no": "R"}), ("source", {})):
        (tmp_path / name).write_text(json.dumps({**seed, **more}))
    jobs.make_variants(spark, layout, str(tmp_path / "seeds"), str(tmp_path / "source"))
    assert {r["report-no"] for r in _records(layout.export("variant"))} == {"R"}
    completed = spark.createDataFrame(
        [("1", "t", "R", 1, None, None), ("2", "t", None, None, "v", 3)], "id string,title string,`report-no` string,year int,venue string,n_citations int"
    )
    writers.write_completed(completed, str(tmp_path / "completed"))
    assert sorted(_records(tmp_path / "completed"), key=lambda r: r["id"]) == [
        {"id": "1", "title": "t", "report-no": "R", "year": 1, "venue": None, "n_citations": None},
        {"id": "2", "title": "t", "year": None, "venue": "v", "n_citations": 3},
    ]


def test_variant_files_follow_the_output(spark, tmp_path):
    papers = spark.range(400).selectExpr(
        "id", "'s' AS s2_id", "'t' AS title", "'a' AS abstract", "'v' AS venue", "array('A') AS authors", "1 AS year", "1 AS n_citations"
    )
    seeds = papers.limit(5)
    writers.write_variants(variant.text_variants(seeds, papers.repartition(20), "x"), str(tmp_path / "v"))
    assert len(list((tmp_path / "v").rglob("part-*.json"))) <= 2 * 5 * 4
    assert len(_lines(tmp_path / "v")) == 5 * 400 * 4


def test_variants_of_few_seeds_are_not_shuffled(spark, tmp_path):
    papers = spark.range(300).selectExpr(
        "id", "'s' AS s2_id", "'t' || id AS title", "repeat('a', 500) AS abstract", "'v' AS venue", "array('A') AS authors", "1 AS year", "1 AS n_citations"
    )
    rows = variant.text_variants(papers.filter("id < 5"), papers.repartition(3), "x")
    for name, folders in (("few", 5 * 4), ("many", 1_000)):
        writers.write_variants(rows, str(tmp_path / name), folders, writers.COMPRESSED)
        files = list((tmp_path / name).rglob("part-*.json.gz"))
        assert len(files) == (3 * 5 * 4 if name == "few" else 5 * 4)
        stored = spark.read.schema(rows.schema).json(str(tmp_path / name))
        assert stored.count() == 5 * 300 * 4 and stored.select(*rows.columns).exceptAll(rows).isEmpty()


def test_masks_and_variants_can_be_compressed(spark, tmp_path):
    source = tmp_path / "source"
    source.write_text("\n".join(json.dumps({"id": i, "s2_id": f"s{i}", "title": f"t{i}", "abstract": "some words " * 50}) for i in range(50)))
    (seeds := tmp_path / "seeds").write_text(json.dumps({"id": 1, "s2_id": "s1", "title": "seed", "abstract": "seed"}))
    read, size = {}, {}
    for command in (["mask", str(source)], ["variant", str(seeds), str(source)]):
        for compression in (writers.PLAIN, writers.COMPRESSED):
            path = run(spark, ["--base", str(tmp_path / compression), *command, "--compression", compression])
            files = [p for p in Path(path).rglob("part-*")]
            assert files and all((p.suffix == ".gz") == (compression == writers.COMPRESSED) for p in files)
            read[compression] = sorted(r.value for r in spark.read.text(path).select("value").collect()) if command[0] == "mask" else spark.read.text(path).count()
            size[compression] = sum(p.stat().st_size for p in files)
        assert read[writers.PLAIN] == read[writers.COMPRESSED] and size[writers.COMPRESSED] < size[writers.PLAIN] / 2


def test_json_array_and_sinks(spark, tmp_path):
    array = tmp_path / "raw.json"
    objects = [{"id": "1", "title": "a, b", "authors_parsed": [["x", "y"]]}, {"id": "2", "abstract": "[\n]"}]
    array.write_text("[\n" + ",\n".join(json.dumps(o) for o in objects) + "\n]")
    got = {r.id: r for r in readers.read_json_array(spark, str(array)).collect()}
    assert got["1"].title == "a, b" and got["2"].abstract == "[\n]" and got["2"].title is None

    index = spark.createDataFrame([(1, "csai"), (2, "csai"), (1, "cslg")], schemas.LABEL_INDEX)
    writers.write_label_index(index, str(tmp_path / "index"))
    writers.export_label_index(index, str(tmp_path / "lines"))
    assert sorted(_lines(tmp_path / "lines" / "cate=csai")) == ["1", "2"]
    assert readers.read_table(spark, str(tmp_path / "index"), schemas.LABEL_INDEX).count() == 3
    writers.write_one_label(index.limit(0), str(tmp_path / "index"), "csai")
    assert readers.read_table(spark, str(tmp_path / "index"), schemas.LABEL_INDEX).count() == 1

    labelled = readers.read_json_array(spark, str(array)).selectExpr("*", "'cs' AS cate")
    writers.write_category_papers(labelled, str(tmp_path / "cate"))
    assert {len(r) for r in _records(tmp_path / "cate" / "cate=cs")} == {2, 3}

    target = str(tmp_path / "table")
    rows = [("a", None, None, None, 0, 0)]
    new = spark.createDataFrame(rows * 2 + [("b", *rows[0][1:])], schemas.WORKLIST)
    writers.append_new(new, spark.createDataFrame([], schemas.WORKLIST), target)
    writers.append_new(new, readers.read_table(spark, target, schemas.WORKLIST), target)
    assert sorted(r.id for r in readers.read_table(spark, target, schemas.WORKLIST).collect()) == ["a", "b"]


def test_command_line(spark, layout):
    from paperloom.__main__ import COMMANDS, run

    def call(*arguments):
        return run(spark, ["--base", layout.base, *map(str, arguments)])

    assert call("extract-topic", "cs", "ml", "--seed", 1, "--limit", 2).first().picked == 2
    assert call("extract-topic", "cs", "ml", "--seed", 1, "--store").first().picked == 3
    assert call("topic-count", "cs", "ml").first().matched == 3
    assert call("fill-data-status", "cs_ml", "-1").first().total == 3
    _shard(layout, "s2-000", ["Databases"])
    call("extract-s2-cs-data")
    assert call("s2-cs-data-count").first()[0] == 1
    assert len(_records(call("export-s2-cs-data", 1, 30))) == 1
    assert len(_records(call("export-s2-cs-data-rand", "--amount", 1))) == 1
    assert len(COMMANDS) == 24
