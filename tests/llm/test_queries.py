"""The registered queries on whole given tables: against their SQL, and the pipeline stage by stage."""

import collections
import glob
import hashlib
import os

import duckdb
import numpy as np
import pytest
import test_secret_scan
import test_simhash
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from paperloom.llm import decontaminate, queries, quality
from paperloom.llm.tables import table

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", list(queries.SQL))
def test_query_equals_sql(spark, duck, name):
    result = contract.queries()[name](spark, SF_DIR)
    relation = duck.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in relation.description]
    assert sorted(result.columns) == sorted(columns)
    got = collections.Counter(map(tuple, result.select(*columns).collect()))
    expected = collections.Counter(relation.fetchall())
    assert expected and got == expected, (list((got - expected).items())[:3], list((expected - got).items())[:3])


def test_all_are_registered():
    names = list(contract.queries())
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5


def _leaked(text, matcher):
    """Every passage against the whole text, without looking for pieces first."""
    words = decontaminate.words_of(text)
    for passage in matcher.passages:
        least = min((s for s, _ in decontaminate.distance_ends(passage.masks, len(passage.words), words)), default=99)
        if least <= passage.budget:
            return True
    return False


def _redacted(text, spans):
    """Spans of (start, kind, end) replaced from the right, overlapping ones together."""
    merged = []
    for start, _, stop in spans:
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], stop)
        else:
            merged.append([start, stop])
    for start, stop in reversed(merged):
        text = text[:start] + "[SECRET]" + text[stop:]
    return text


def test_pipeline_equals_brute_force(spark, tmp_path):
    """Each stage on what the stage before it kept: the learned one against the operator's scores, the others against
    brute-force versions or the tokenizers library."""
    docs = table(spark, SF_DIR, "documents")
    labels, benchmark = table(spark, SF_DIR, "labels"), table(spark, SF_DIR, "benchmark")
    outputs = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{i}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{i}")
        outputs.append((before, docs))
    columns = table(spark, SF_DIR, "documents").columns
    assert all(after.columns == columns for _, after in outputs[:-1])
    ids = lambda frame: sorted(r.doc_id for r in frame.select("doc_id").collect())

    before, after = outputs[0]
    assert ids(after) == ids(quality.score_documents(before, labels).where("score >= 0.5")) and ids(after) != ids(before)
    before, after = outputs[1]
    groups = test_simhash.brute([(r.doc_id, r.text) for r in before.collect()])
    assert ids(after) == sorted({component for _, _, component in groups}) and ids(after) != ids(before)
    before, after = outputs[2]
    matcher = decontaminate.Matcher([(r.item_id, r.text) for r in benchmark.collect()])
    leaked = {r.doc_id for r in before.collect() if _leaked(r.text, matcher)}
    assert ids(after) == sorted(set(ids(before)) - leaked) and leaked
    before, after = outputs[3]
    assert ids(after) == ids(before)
    old, new = ({r.doc_id: r for r in frame.collect()} for frame in (before, after))
    changed = {i for i in old if old[i].text != new[i].text}
    assert changed and all(new[i].text == _redacted(old[i].text, test_secret_scan.brute(old[i].text)[1]) for i in old)
    assert all(new[i].n_chars == len(new[i].text) for i in changed) and all(old[i] == new[i] for i in old if i not in changed)
    assert queries.secret_scan.scan_documents(after).where("spans <> ''").isEmpty()
    before, after = outputs[4]
    library = Tokenizer.from_file(queries.TOKENIZER)
    expected = set()
    for r in before.collect():
        tokens = np.array(library.encode(r.text, add_special_tokens=False).ids, "<u4")
        expected.add((r.doc_id, len(tokens), hashlib.sha256(tokens.tobytes()).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest()))
    assert set(map(tuple, after.collect())) == expected
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF_DIR).collect())) == sorted(map(tuple, after.collect()))


def test_stages_take_edge_rows_and_empty_tables(spark, docs_of, edge_rows):
    given = table(spark, SF_DIR, "documents")
    rows = [(*row, None, None, None) for row in edge_rows]
    edge = spark.createDataFrame(rows, given.schema)
    by_name = dict(corpus_pipeline.STAGES)
    for name, stage in by_name.items():
        assert stage(spark, edge.limit(0), SF_DIR).count() == 0, name
    ids = lambda stage: sorted((r.doc_id is None, r.doc_id or 0) for r in by_name[stage](spark, edge, SF_DIR).collect())
    every = sorted((i is None, i or 0) for i, _ in edge_rows)
    scores = quality.score_documents(edge, table(spark, SF_DIR, "labels")).where("score >= 0.5").collect()
    assert ids("quality classifier") == sorted((r.doc_id is None, r.doc_id or 0) for r in scores)
    # Null and blank texts are one component, equal texts another; each other text is its own.
    assert ids("SimHash near-dedup") == [(False, i) for i in (1, 4, 5, 7, 8, 8)] + [(True, 0)]
    assert ids("benchmark decontamination") == ids("secret scans") == ids("BPE encoding and decoding") == every
    redacted = {r.doc_id: r for r in by_name["secret scans"](spark, edge, SF_DIR).collect()}
    assert redacted[7].text.endswith("[SECRET]") and redacted[7].n_chars == len(redacted[7].text) and redacted[1].text is None


def test_stages_pass_clashing_columns_on(spark):
    """Columns under names that operators work with themselves are kept as they are."""
    more = "spans string, spans_ string, __base int, __more int, __key int, __own int, __id int, fp long, row int, found int, a int, b int, x string, root long"
    names = [part.split()[0] for part in more.split(", ")]
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {more}"
    values = ("s", "t", 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, "x", 11)
    rows = [(i, f"some plain words of text number {i} with password=abcdefghij{i}{i}", "en", "s", 9, *values) for i in (11, 12)]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns, name
        assert all(tuple(r[n] for n in names) == values for r in out.collect()), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() == 2
