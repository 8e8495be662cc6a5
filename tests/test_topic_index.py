"""Requirements derived from regexes, and the indexed search against the whole scan."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paperloom import registry as reg
from paperloom.functions import trigrams
from paperloom.operators import extract, topic_index

ALWAYS = trigrams.ALWAYS


def _present(text):
    folded = text.translate(str.maketrans(trigrams.FOLDED, trigrams.FOLDED_TO)).lower()
    return {trigrams.number(folded[i : i + 3]) for i in range(len(folded) - 2) if max(map(ord, folded[i : i + 3])) < 128}


def _holds(formula, present):
    if formula is ALWAYS:
        return True
    if isinstance(formula, int):
        return formula in present
    return (all if formula[0] == "and" else any)(_holds(part, present) for part in formula[1])


def _spell(formula):
    if formula is ALWAYS or isinstance(formula, int):
        return formula if formula is ALWAYS else "".join(chr(formula >> s & 127) for s in (14, 7, 0))
    return (formula[0], frozenset(map(_spell, formula[1])))


def test_requirements():
    spell = lambda regex: _spell(trigrams.required(regex))
    assert spell("abcd") == ("and", {"abc", "bcd"})
    assert spell("ABC") == "abc" and spell("ab") is ALWAYS and spell("") is ALWAYS
    assert spell("abc|xyz") == ("or", {"abc", "xyz"}) and spell("abc|xy") is ALWAYS
    assert spell("abc.*xyz") == ("and", {"abc", "xyz"})
    assert spell("a(b|c)d") == ("or", {"abd", "acd"}) and spell("ab?cd") == ("or", {"acd", ("and", frozenset({"abc", "bcd"}))})
    assert spell("(abc)+") == "abc" and spell("(abc)*") is ALWAYS and spell("(abc){2,}") == "abc"
    assert spell("^abc$") == spell(r"\babc(?=d)") == "abc" and spell("[^a]bcd") == "bcd" and spell("é|abc") is ALWAYS
    assert spell(r"\Qa.c\E") is ALWAYS and spell("(?x) a b c") is ALWAYS and spell("(") is ALWAYS and spell("[a-z&&[^b]]bcd") is ALWAYS
    learning = trigrams.required("(machine( |-)learning)")
    assert learning is not ALWAYS and learning[0] == "or" and len(learning[1]) == 2


@settings(max_examples=400, deadline=None)
@given(st.recursive(
    st.sampled_from(["a", "b", "k", "s", ".", "[ab]", "[^a]", " ", "é", "abc", "ksa", r"\w", "^", "$", r"\b"]),
    lambda inner: st.one_of(
        st.lists(inner, min_size=1, max_size=4).map("".join), st.lists(inner, min_size=2, max_size=3).map(lambda x: "(" + "|".join(x) + ")"),
        inner.map(lambda x: f"({x})?"), inner.map(lambda x: f"({x})+"), inner.map(lambda x: f"({x}){{2}}"), inner.map(lambda x: f"(?:{x})*"),
    ), max_leaves=8,
), st.lists(st.text("abcksABKS éKſ\n", max_size=30), min_size=1, max_size=8))
def test_a_requirement_is_necessary(regex, texts):
    formula = trigrams.required(regex)
    for text in texts:
        if re.search(regex, text, re.I | re.M):
            assert _holds(formula, _present(text)), (regex, text)


def test_trigrams_of_texts(spark):
    texts = ["", "ab", "abc", "Machine Learning", "a\nbc é x yz", "Kissſ", "漢字abc漢", None, "aaaa" * 50]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", trigrams.trigrams(F.col("t")).alias("n")).collect()
    for r in rows:
        assert len(r.n) == len(set(r.n)) and set(r.n) == _present(r.t or ""), r.t


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("topics")
    rng = random.Random(2)
    words = [f"{a}{b}" for a in ("deep", "graph", "image", "fast", "lin") for b in ("ing", "ear", "er", "s", "al")]
    rows = []
    for i in range(6000):
        title = " ".join(rng.choices(words, k=6))
        if i in (17, 18, 2900, 5999):
            title += " Quantum Computing"
        if 4000 <= i < 4100:
            title += " machine-learning"
        rows.append((i + 1, title, "abstract " + " ".join(rng.choices(words, k=20)) if i % 7 else None, f"p{i // 1500}"))
    papers = spark.createDataFrame(rows, "id long,title string,abstract string,partition string")
    papers.repartition("partition").sortWithinPartitions("partition", "id").write.option("maxRecordsPerFile", 100).partitionBy("partition").parquet(f"{base}/papers")
    papers = spark.read.schema(papers.schema).parquet(f"{base}/papers")
    topic_index.write_postings(topic_index.postings(papers), f"{base}/index")
    return papers, spark.read.schema(topic_index.SCHEMA).parquet(f"{base}/index"), base


def _scanned(frame):
    """Rows that the scans of papers gave, after row groups were left out."""
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan()
    found, todo = 0, [plan]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
        elif name.endswith("QueryStage"):
            todo.append(node.plan())
        if name.startswith("Scan parquet"):
            found += node.metrics().apply("numOutputRows").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.length())]
    return found


@pytest.mark.parametrize("regex", ["quantum( |-)computing", "(machine( |-)learning)", "graph", "no such words", "deeping|quantum", "", "^deep.*er$", "ab", "lin(ear|al) "])
def test_equals_the_whole_scan(corpus, regex):
    papers, index, _ = corpus
    ids = lambda frame: sorted(r.id for r in frame.select("id").collect())
    assert ids(topic_index.in_topic_indexed(papers, index, regex)) == ids(extract.in_topic(papers, regex))
    assert ids(topic_index.in_topic_indexed(papers, index, regex, ranges=2)) == ids(extract.in_topic(papers, regex))


def test_reads_only_a_part(corpus):
    papers, index, _ = corpus
    rare = topic_index.in_topic_indexed(papers, index, "quantum( |-)computing")
    assert rare.count() == 4 and _scanned(rare) <= 3 * 400
    assert "id" in rare._jdf.queryExecution().executedPlan().toString().split("PushedFilters")[1][:200]
    assert _scanned(topic_index.in_topic_indexed(papers, index, "no such words")) == 0
    assert _scanned(topic_index.in_topic_indexed(papers, index, "ab")) == 6000


def test_shards_outside_the_index_and_added_ones(spark, corpus, tmp_path):
    papers, _, _ = corpus
    path = str(tmp_path / "index")
    for shards in (["p0"], ["p2", "p0"]):
        topic_index.write_postings(topic_index.postings(papers.filter(F.col("partition").isin(shards))), path)
        index = spark.read.schema(topic_index.SCHEMA).parquet(path)
        found = topic_index.in_topic_by_shards(papers, index, "quantum( |-)computing")
        assert sorted(r.id for r in found.collect()) == [18, 19, 2901, 6000]
    assert index.select("partition").distinct().count() == 2
    assert index.count() == index.distinct().count()


def test_every_topic_of_the_registry_has_a_requirement():
    regexes = [regex for cate in reg.default_registry() for regex in cate.topics.values()]
    assert regexes and all(trigrams.required(r) is not ALWAYS for r in regexes if r)


def test_a_long_shard_is_dealt_out_by_its_texts(spark, corpus, tmp_path):
    """Also behind a join that brings a shard's papers together; no granule is split, so no posting stands twice."""
    papers, index, _ = corpus
    shards = papers.select("partition").distinct()
    joined = papers.hint("shuffle_hash").join(shards, "partition", "left_semi")
    rows = topic_index.postings(joined, task_characters=50_000)
    per_task = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert len(per_task) > 3 * 4 and max(per_task) < rows.count() / 8
    topic_index.write_postings(rows, str(tmp_path / "index"))
    stored = spark.read.schema(topic_index.SCHEMA).parquet(str(tmp_path / "index"))
    assert stored.count() == index.count() and stored.exceptAll(index).isEmpty()


def test_the_search_does_not_gather_a_shard_in_one_task(spark, corpus):
    papers, index, _ = corpus
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = topic_index.in_topic_by_shards(papers, index, "quantum( |-)computing")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 2
