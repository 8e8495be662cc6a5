"""What the physical plans must look like."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from paperloom import registry as reg
from paperloom.operators import complete, counts, export, extract, mask, match, sample, variant, worklist
from paperloom.plans import testdata
from paperloom.plans.queries import REGISTERED
from paperloom.sources import readers

SF_DIR = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """A small corpus table with two shards, and a snapshot."""
    base = tmp_path_factory.mktemp("plans")
    rows = spark.range(1, 2_001).select(
        "id", F.concat(F.lit("s"), "id").alias("s2_id"), F.concat(F.lit("t"), F.chr(F.col("id") % 26 + 97)).alias("title"),
        F.lit("about").alias("abstract"), F.array(F.lit("A B")).alias("authors"), F.lit("v").alias("venue"),
        F.lit(2000).alias("year"), F.lit(1).alias("n_citations"),
        F.concat(F.lit("t"), F.chr(F.col("id") % 26 + 97)).alias("title_key"),
        F.when(F.col("id") <= 1_000, "p0").otherwise("p1").alias("partition"),
    )
    rows.write.partitionBy("partition").parquet(str(base / "papers"))
    ids = spark.range(5)
    ids.write.parquet(str(base / "ids"))
    return readers.read_papers(spark, str(base / "papers")), spark.read.parquet(str(base / "ids")), base


@pytest.mark.parametrize("name", [n for n in REGISTERED if n != "incremental_ingest"])
def test_queries_stay_in_the_jvm_and_off_cross_joins(spark, name):
    plan = _plan(contract.queries()[name](spark, SF_DIR))
    assert not re.search("Python|Pandas|CartesianProduct|NestedLoop", plan)


def test_labels_take_one_scan(spark):
    plan = _plan(contract.queries()["category_labels"](spark, SF_DIR))
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_count_reads_two_columns(spark, corpus):
    plan = _plan(extract.topic_count(corpus[0], "nlp"))
    assert "ReadSchema: struct<title:string,abstract:string>" in plan


def test_corpus_count_reads_no_column(spark, corpus):
    assert "ReadSchema: struct<>" in _plan(counts.corpus_count(corpus[0]))


def test_shards_are_pruned(spark, corpus):
    plan = _plan(readers.read_papers(spark, str(corpus[2] / "papers"), columns=["id", "title"], shards=["p1"]))
    assert re.search(r"PartitionFilters: \[[^\]]*p1", plan) and "ReadSchema: struct<id:bigint,title:string>" in plan


def test_range_is_pushed_down(corpus):
    plan = _plan(export.by_range(corpus[0], 100, 50))
    assert "GreaterThan(id,100)" in plan and "LessThanOrEqual(id,150)" in plan and "Exchange" not in plan


def test_short_id_list_is_broadcast_and_long_one_shuffled(spark, corpus):
    papers, ids, _ = corpus
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        short = export.by_ids(papers, ids)
        ranges, long = export.by_ids(papers, ids, broadcast_bytes=16), export.by_ids(papers, ids, broadcast_bytes=16, most_parts=2)
        assert re.search("BroadcastHashJoin.*LeftSemi", _plan(short))
        # A list above the threshold: one pushed-down range and broadcast per part, and no shuffle of the wide papers.
        plan = _plan(ranges)
        assert plan.count("BroadcastHashJoin") == 5 and not re.search("Exchange hashpartitioning|SortMergeJoin", plan)
        assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(id", plan)
        assert re.search("SortMergeJoin.*LeftSemi", _plan(long))
        assert short.count() == ranges.count() == long.count() == 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _index(spark):
    rows = [("1", "tb", "cs.AI"), ("2", "tc", "cs.AI")]
    snapshot = spark.createDataFrame(rows, "id STRING, title STRING, categories STRING")
    return match.title_index(snapshot, [reg.category("csai")])


def test_short_index_leaves_the_corpus_in_place(spark, corpus):
    plan = _plan(match.match_titles(_index(spark), corpus[0]).select("cate", "id"))
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "BroadcastHashJoin" in plan and "ReadSchema: struct<id:bigint,title_key:string>" in scan


def test_long_index_spreads_hot_keys(spark, corpus):
    got = match.match_titles(_index(spark), corpus[0], hot_rows=10, broadcast_bytes=0)
    plan = _plan(got.select("cate", "id"))
    assert re.search(r"\[_slot#\w+, title_key#\w+\]", plan)
    assert got.count() == corpus[0].filter("title_key IN ('tb', 'tc')").count()


def test_title_index_folds_before_the_shuffle(spark):
    assert "partial_max_by" in _plan(_index(spark))


def test_positions_need_no_global_window(spark, corpus):
    plan = _plan(sample.dense_id(corpus[0].select("s2_id"), "s2_id", 1))
    windows = [line for line in plan.splitlines() if re.search(r"Window \[row_number", line)]
    assert windows and all("_bucket" in line for line in windows)
    # The only single-task step works on the counts per bucket.
    below = plan[plan.index("SinglePartition"):]
    assert "HashAggregate(keys=[_bucket" in below


def test_sample_filters_before_it_ranks(corpus):
    plan = _plan(sample.sample(corpus[0].select("id", "title"), "id", 10, 1))
    assert "SinglePartition" not in plan and re.search(r"Filter .*_bucket|Filter .*substring\(md5", plan)


def test_variants_have_no_join(spark, corpus):
    seeds = corpus[0].filter("id <= 3")
    plan = _plan(variant.text_variants(seeds, corpus[0], "x"))
    assert "Join" not in plan
    plan = _plan(variant.text_variants(seeds, corpus[0], "x", inline_seeds=1))
    assert re.search(r"Join \[fragment#\w+, split#\w+\]", plan)
    # The sources are read from their files, not from a copy.
    assert "FileScan parquet" in plan and "Scan ExistingRDD" not in plan
    heavy = variant.text_variants(seeds, corpus[0], "x")
    assert heavy.count() == 3 * 2_000 * 4


def test_long_seed_texts_do_not_travel_with_the_plan(spark, corpus):
    seeds = corpus[0].filter("id <= 3")
    paired = variant.pair_with_seeds(corpus[0], seeds, inline_bytes=300)
    assert "Join" in _plan(paired) and paired.count() == 3 * 2_000


def test_status_scans_each_table_once(spark):
    plan = _plan(contract.queries()["fill_status"](spark, SF_DIR))
    assert plan.count("orders.parquet") == 1 and plan.count("lineitem.parquet") == 1


def test_masks_of_gappy_papers_scan_documents_once(spark):
    assert _plan(contract.queries()["mask_features"](spark, SF_DIR)).count("documents.parquet") == 1


def test_masks_take_one_scan_without_shuffle(corpus):
    plan = _plan(mask.mask_features(export.record_columns(corpus[0])))
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_response_is_parsed_once(spark):
    responses = testdata.responses(spark, SF_DIR)
    assert _plan(complete.with_state(responses).select("id", "state")).count("parseJson") == 1
    assert _plan(complete.settled_responses(responses)).count("parseJson") == 1


def test_status_takes_one_shuffle_of_ids(spark):
    main = testdata.worklist(spark, SF_DIR)
    plan = _plan(worklist.fill_status(main, main))
    assert plan.count("Exchange hashpartitioning(id") == 1 and "partial_max" in plan


def test_key_filter_of_a_long_index(spark):
    """Before the shuffle, titles that can't match are left out: none that match, and most of the others."""
    index = spark.range(2_000).selectExpr("'cslg' AS cate", "concat('title ', id * 7) AS title_key", "cast(id AS string) AS arxiv_id", "'t' AS a_title", "'cs.LG' AS categories")
    corpus = spark.range(40_000).selectExpr("id", "concat('Title ', id) AS title", "concat('title ', id) AS title_key")
    narrow = corpus.withColumnRenamed("title", "s_title")
    passed = match.may_match(narrow, index, 2_000)
    assert passed.columns == narrow.columns
    ids = {r.id for r in passed.select("id").collect()}
    matching = {i for i in range(40_000) if i % 7 == 0 and i < 14_000}
    assert matching <= ids and len(ids - matching) < 0.2 * 40_000
    found = match.match_titles(index, corpus, broadcast_bytes=0)
    assert sorted(r.id for r in found.select("id").collect()) == sorted(matching)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "bitmap_construct_agg" in plan
    # A filter that is too small for its keys lets more through and loses nothing.
    assert matching <= {r.id for r in match.may_match(narrow, index, 1).select("id").collect()}
    assert match.may_match(narrow, index.limit(0), 0).count() == 0
    nothing = narrow.limit(0)
    assert match.may_match(nothing, index, 2_000).count() == 0
