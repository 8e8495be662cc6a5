"""Responses as a stream: any order, any cut into files, batches and runs gives what one job over all of them gives."""

import itertools
import json
import random
from pathlib import Path

import pytest

from paperloom import schemas
from paperloom.operators import complete
from paperloom.plans import commands as jobs
from paperloom.sources import writers
from paperloom.streaming import completion

BODIES = {
    "done": '{"venue": "A", "year": 2001, "citationCount": 3}', "partly": '{"venue": null, "year": 2001, "citationCount": 3}',
    "error": '{"error": "none"}', "broken": "<html>", "open": "{}",
}


def _response(paper, kind):
    return {"id": paper, "status": 403 if kind == "open" else 200, "body": BODIES[kind]}


def _land(folder, number, responses):
    Path(folder).mkdir(parents=True, exist_ok=True)
    (Path(folder) / f"r{number:03}.json").write_text("".join(json.dumps(r) + "\n" for r in responses))


@pytest.fixture
def places(tmp_path):
    return [str(tmp_path / name) for name in ("responses", "outcomes", "checkpoint")]


def _rows(frame):
    return sorted(map(tuple, frame.collect()))


def test_any_order_over_several_runs(spark, places):
    rng = random.Random(1)
    papers = {f"p{i}": kinds for i, kinds in enumerate(itertools.chain(itertools.combinations(BODIES, 2), [("open",), ("done", "done")]))}
    responses = [_response(paper, kind) for paper, kinds in papers.items() for kind in kinds]
    rng.shuffle(responses)
    for number, part in enumerate((responses[:7], responses[7:9], [], responses[9:])):
        _land(places[0], number, part)
        completion.settle(spark, *places, bytes_per_batch=400)
    everything = spark.createDataFrame([(r["id"], r["status"], r["body"]) for r in responses], schemas.RESPONSES)
    expected = complete.settled_responses(everything).select(*completion.OUTCOMES.fieldNames())
    found = _rows(completion.outcomes(spark, places[1]))
    assert found == _rows(expected) and len(found) == 11
    # A run without new responses changes nothing; neither does folding the change sets.
    completion.settle(spark, *places)
    completion.compact(spark, places[1])
    assert _rows(completion.outcomes(spark, places[1])) == found
    _land(places[0], 9, [_response("p0", "broken"), _response("new", "done")])
    completion.settle(spark, *places, change_sets=0)
    assert len(_rows(completion.outcomes(spark, places[1]))) == 12
    assert {r[0]: r for r in _rows(completion.outcomes(spark, places[1]))}["p0"] == {r[0]: r for r in found}["p0"]
    assert len(list((Path(places[1]) / "folded").glob("snapshot=*"))) == 2


def test_a_late_response_never_takes_back(spark, places):
    for number, kind in enumerate(("open", "error", "partly", "done", "error", "open", "partly")):
        _land(places[0], number, [_response("a", kind)])
        completion.settle(spark, *places)
        state = {r.id: (r.filled, r.venue) for r in completion.outcomes(spark, places[1]).collect()}
        assert state == ({}, {"a": (2, None)}, {"a": (1, None)}, *[{"a": (1, "A")}] * 4)[number]


def test_a_broken_off_fold_does_not_count(spark, places):
    _land(places[0], 0, [_response("a", "done")])
    completion.settle(spark, *places)
    completion.compact(spark, places[1])
    folded = Path(places[1]) / "folded" / "snapshot=0"
    assert folded.is_dir()
    (folded / "_SUCCESS").unlink()
    assert [r.id for r in completion.outcomes(spark, places[1]).collect()] == ["a"]


def test_nothing_has_arrived(spark, places):
    Path(places[0]).mkdir()
    completion.settle(spark, *places)
    assert completion.outcomes(spark, places[1]).collect() == []
    completion.compact(spark, places[1])


def test_jobs_over_the_stream(spark, tmp_path):
    """Status and merge see what the stream has settled; papers of other lists and merged ones are left alone."""
    layout = jobs.Layout(str(tmp_path / "base"))
    rows = [(f"p{i}", None, None, None, i % 3, 0) for i in range(6)] + [("old", "V", 1990, 1, 0, 1)]
    writers.write_snapshot(spark.createDataFrame(rows, schemas.WORKLIST), f"{layout.worklist('cs_ml')}/snapshot=0")
    folder = layout.responses("cs_ml")
    _land(folder, 0, [_response("p0", "done"), _response("p1", "error"), _response("old", "done"), _response("foreign", "done")])
    status = jobs.fill_data_stream(spark, layout, "cs_ml").first()
    assert (status.total, status.filled, status.error, status.unfilled, status.pending_net) == (7, 2, 1, 6, 4)
    _land(folder, 1, [_response("p1", "done"), _response("p2", "open")])
    status = jobs.fill_data_stream(spark, layout, "cs_ml").first()
    assert (status.filled, status.error, status.pending_net) == (3, 0, 4)
    jobs.merge_data(spark, layout, "cs_ml")
    main, _ = jobs.latest(spark, layout.worklist("cs_ml"), schemas.WORKLIST)
    merged = {r.id: (r.venue, r.filled) for r in main.collect()}
    assert merged == {"p0": ("A", 1), "p1": ("A", 1), **{f"p{i}": (None, 0) for i in range(2, 6)}, "old": ("V", 1)}
