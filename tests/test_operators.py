"""Operators on small frames, including the edge rows listed in FIXTURES.md."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from paperloom import registry as reg
from paperloom import schemas
from paperloom.operators import complete, counts, export, extract, mask, match, sample, variant, worklist


def _rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


# --- registry and extraction --------------------------------------------------------------------------


def test_registry():
    registry = reg.default_registry()
    assert len(registry) == 41 and len({c.name for c in registry}) == 41
    assert reg.category("csai").regex == r"cs\.AI" and registry[1].name == "csai"
    assert reg.topic_regex("cs", "ml") == "(machine( |-)learning)" and reg.topic_regex("cslg", "all") == ""
    with pytest.raises(KeyError):
        reg.topic_regex("csar", "all")


def test_labels(spark):
    df = spark.createDataFrame([("1", "cs.AI math.OC cs.LG"), ("2", "math.OC"), ("3", None)], "id STRING, categories STRING")
    assert _rows(extract.label_papers(df, reg.default_registry()), "id", "cate") == [
        ("1", "cs"), ("1", "csai"), ("1", "cslg"),
    ]
    assert tuple(extract.category_count(df, reg.category("cslg")).first()) == (1, 3)


def test_completeness(spark):
    rows = [
        (1, None, "a", 2000), (2, "", "a", 2000), (3, "v", None, 2000), (4, "v", "", 2000), (5, "v", "a", None),
        (6, "v", "a", 2000),
    ]
    df = spark.createDataFrame(rows, "id INT, venue STRING, abstract STRING, year INT")
    assert _rows(df.filter(extract.is_complete()), "id") == [(1,), (6,)]


def test_shard_records(spark):
    good = ("a", "T-1", "text", [("x",), ("y",)], ["c", "d"], ["Computer Science"], "v", 2001, "s")
    no_field = ("b", *good[1:5], None, *good[6:])
    no_title = ("c", None, *good[2:])
    no_citations = ("d", *good[1:4], None, *good[5:])
    schema = schemas.plus(schemas.SHARD_RECORD, "partition", schemas.TEXT)
    got = extract.reshape_shard_records(spark.createDataFrame([good, no_field, no_title, no_citations], schema))
    assert _rows(got, "s2_id", "authors", "n_citations", "title_key", "abstract") == [
        ("a", ["x", "y"], 2, "t", "text"), ("d", ["x", "y"], 0, "t", "text"),
    ]


def test_unusable_counts(spark):
    schema = schemas.plus(schemas.SHARD_RECORD, "partition", schemas.TEXT)
    row = ("a", "T", "text", [], [], ["Computer Science"], "v", 2001, "s")
    rows = [row, ("b", None, *row[2:]), (*row[:5], None, *row[6:])]
    assert tuple(extract.unusable_counts(spark.createDataFrame(rows, schema)).first()) == (3, 0, 1, 1, 0)


# --- random order -------------------------------------------------------------------------------------


@pytest.mark.parametrize("n, sizes", [(0, []), (1, [1]), (2, [2]), (3, [1, 1, 1]), (7, [2, 2, 3]), (8, [2, 2, 4])])
def test_three_way_split(spark, n, sizes):
    got = sample.three_way_split(spark.range(n), "id", 3).groupBy("partition").count().orderBy("partition")
    assert [r["count"] for r in got.collect()] == sizes


def test_dense_id(spark):
    got = sample.dense_id(spark.range(5_000).withColumnRenamed("id", "k"), "k", 1)
    assert sorted(r.id for r in got.collect()) == list(range(1, 5_001))


@pytest.mark.parametrize("n", [1, 10, 999, 1_000, 1_001])
def test_sample_is_the_head_of_the_order(spark, n):
    from paperloom.functions.ordering import order_hash

    df = spark.range(1_000)
    expected = [r.id for r in df.orderBy(order_hash(F.col("id"), 5)).limit(n).collect()]
    assert _rows(sample.sample(df, "id", n, 5), "id") == sorted((i,) for i in expected)


@pytest.mark.parametrize("limit", [10_000, 1])
def test_sample_per_group(spark, limit, monkeypatch):
    monkeypatch.setattr(sample, "MAX_CUT_ROWS", limit)
    df = spark.range(300).withColumn("g", F.when(F.col("id") < 290, "big").otherwise("small"))
    got = sample.sample(df, "id", 20, 5, by=["g"])
    assert Counter(r.g for r in got.collect()) == {"big": 20, "small": 10}


def test_sample_of_nothing(spark):
    assert sample.sample(spark.range(0), "id", 5, 1).collect() == []


# --- matching -----------------------------------------------------------------------------------------

SNAPSHOT = [
    ("1", "Deep Nets", "cs.AI"), ("2", "deep-nets!", "cs.AI cs.LG"), ("3", "42", "cs.AI"), ("4", "Other", "math.OC"),
    ("5", None, "cs.AI"),
]
CORPUS = [(10, "DEEP NETS"), (11, "Deep  nets"), (12, "deepnets"), (13, "2020"), (14, "Unknown"), (15, None), (16, "Other")]


def _match(spark, drop_empty_key=False, **options):
    snapshot = spark.createDataFrame(SNAPSHOT, "id STRING, title STRING, categories STRING")
    labels = reg.second_level(reg.default_registry())
    index = match.title_index(snapshot, labels, drop_empty_key=drop_empty_key)
    return index, match.match_titles(index, spark.createDataFrame(CORPUS, "id BIGINT, title STRING"), **options)


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0}, {"broadcast_bytes": 0, "hot_rows": 1}])
def test_title_match(spark, options):
    index, got = _match(spark, **options)
    expected = [("csai", i, "2") for i in (10, 11, 12)] + [("csai", 13, "3")] + [("cslg", i, "2") for i in (10, 11, 12)]
    assert _rows(got, "cate", "id", "arxiv_id") == expected
    labels = reg.second_level(reg.default_registry())
    rates = match.match_rate(index, got, labels)
    assert rates.count() == 40
    assert _rows(rates.filter("n_keys > 0"), "cate", "n_keys", "n_matches", "rate") == [
        ("csai", 2, 4, 200.0), ("cslg", 1, 3, 300.0),
    ]
    assert {(r.n_keys, r.n_matches, r.rate) for r in rates.filter("n_keys = 0").collect()} == {(0, 0, None)}


def test_keep_last_does_not_depend_on_the_order_of_rows(spark):
    rows = [("1", "A b", "cs.AI", 5), ("1", "a-b", "cs.AI x", 5), ("2", "AB", "cs.AI", None), ("0", "A.B", "cs.AI", 5)]
    kept = set()
    for order in (rows, rows[::-1], rows[2:] + rows[:2]):
        snapshot = spark.createDataFrame(order, "id STRING, title STRING, categories STRING, o INT").coalesce(1)
        got = match.title_index(snapshot, [reg.category("csai")], F.col("o")).collect()
        kept |= {tuple(r) for r in got}
    assert kept == {("csai", "ab", "1", "a-b", "cs.AI x")}


def test_title_match_without_letterless_titles(spark):
    _, got = _match(spark, drop_empty_key=True)
    assert (13,) not in _rows(got, "id")


def test_one_title_fills_a_third(spark):
    """A hot key is spread over shares, with the same rows as a plain join."""
    snapshot = spark.range(50).select(
        F.col("id").cast("string").alias("id"), F.concat(F.lit("t"), F.chr(F.col("id") + 97)).alias("title"),
        F.lit("cs.AI").alias("categories"),
    )
    other = F.concat(F.lit("t"), F.chr(F.col("id") % 20 + 97))
    corpus = spark.range(3_000).select("id", F.when(F.col("id") < 1_000, "tb").otherwise(other).alias("title"))
    index = match.title_index(snapshot, [reg.category("csai")])
    plain = match.match_titles(index, corpus)
    spread = match.match_titles(index, corpus, hot_rows=100, broadcast_bytes=0)
    assert _rows(spread, "id", "arxiv_id") == _rows(plain, "id", "arxiv_id") and plain.count() == 3_000


def test_rate_without_keys(spark):
    assert spark.range(1).select(match.rate(F.lit(5), F.lit(0))).first()[0] is None


def test_label_counts(spark):
    index = spark.createDataFrame([(1, "csai"), (2, "csai"), (1, "cslg")], schemas.LABEL_INDEX)
    labels = [reg.category(c) for c in ("csar", "cslg", "csai", "cscl")]
    got = counts.label_counts(index, labels)
    assert [(r["cate"], r["count"]) for r in got.collect()] == [("csai", 2), ("cslg", 1), ("csar", 0), ("cscl", 0)]
    total = counts.label_totals(got).filter("cate IS NULL").first()
    assert (total["count"], total["n_labels"]) == (3, 4)


# --- export -------------------------------------------------------------------------------------------


def test_exports(spark):
    papers = spark.range(1, 11)
    ids = spark.createDataFrame([(3,), (3,), (99,)], "id BIGINT")
    assert _rows(export.by_ids(papers, ids), "id") == [(3,)]
    assert _rows(export.by_range(papers, 0, 3), "id") == [(1,), (2,), (3,)]
    assert _rows(export.by_range(papers, 9, 5), "id") == [(10,)]
    assert export.range_name(0, 30) == "completed_s2_1_to_30.data"
    assert [r[0] for r in spark.range(1, 5).select(export.page_of(F.col("id"), 2)).collect()] == [0, 0, 1, 1]


def test_label_export_name(spark):
    def name(size, amount):
        return spark.range(1).select(export.label_export_name(F.lit("csai"), F.lit(size), amount, "run")).first()[0]

    assert name(10, None) == name(10, 10) == name(10, 11) == "completed_s2_arxiv_csai_all_.data"
    assert name(10, 9).startswith("completed_s2_arxiv_csai_rand_9_0x") and name(10, 9).endswith("_.data")


# --- work-list ----------------------------------------------------------------------------------------


def _worklist(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.WORKLIST)


def test_create_worklist_keeps_existing_rows(spark):
    existing = _worklist(spark, ("1", "v", 2000, 3, 2, 1))
    ids = spark.createDataFrame([("1",), ("2",), ("3",), ("3",)], "id STRING")
    got = worklist.create_worklist(ids, existing, 1)
    assert _rows(got, "id", "filled") == [("1", 1), ("2", 0), ("3", 0)]
    assert got.filter("id = '1'").first()["venue"] == "v"


@pytest.mark.parametrize("size, full, added", [(30_000, 30_000, 0), (29_999, 30_000, 2), (30_000, None, 2)])
def test_full_worklist_is_left_alone_only_on_demand(spark, size, full, added):
    existing = spark.range(size).select(
        F.col("id").cast("string").alias("id"), F.lit(None).cast("string").alias("venue"),
        *[F.lit(None).cast("int").alias(c) for c in ("year", "n_citations")],
        F.lit(0).alias("partition"), F.lit(0).alias("filled"),
    )
    ids = spark.createDataFrame([("a",), ("b",), ("7",)], "id STRING")
    assert worklist.create_worklist(ids, existing, 1, full).count() == size + added


def test_repeated_staging_and_responses_leave_one_row_per_id(spark):
    schema = schemas.WORKLIST
    main = spark.createDataFrame([("a", None, None, None, 0, 0), ("b", None, None, None, 1, 0)], schema)
    staging = spark.createDataFrame(
        [
            ("a", None, None, None, 0, 2), ("a", None, 2000, None, 0, 1), ("a", "V", 2000, 3, 0, 1), ("a", None, None, None, 0, 0),
            ("b", None, None, None, 1, 2), ("b", None, None, None, 1, 2),
        ],
        schema,
    )
    merged = worklist.merge_staging(main, staging)
    assert [tuple(r) for r in merged.orderBy("id").collect()] == [("a", "V", 2000, 3, 0, 1), ("b", None, None, None, 1, 2)]
    again = worklist.merge_staging(merged, staging)
    assert again.count() == again.select("id").distinct().count() == 2
    good = '{"venue": "ICML", "year": 2019, "citationCount": 1}'
    empty = '{"venue": null, "year": 2019, "citationCount": 1}'
    rows = [("a", 200, empty), ("a", 200, good), ("a", 404, '{"error": "x"}'), ("b", 403, "{}"), ("c", 404, '{"error": "x"}')]
    settled = complete.settled_responses(spark.createDataFrame(rows, schemas.RESPONSES))
    assert sorted((r.id, r.filled, r.venue) for r in settled.collect()) == [("a", 1, "ICML"), ("c", 2, None)]


def test_status_by_partition_equals_the_single_ones(spark):
    rows = [("a", None, None, None, 0, 0), ("b", None, None, None, 1, 1), ("c", None, None, None, 2, 2), ("d", None, None, None, 7, 0)]
    staged = [("a", None, None, None, 0, 1), ("a", None, None, None, 1, 2), ("e", None, None, None, 2, 0)]
    main, staging = (spark.createDataFrame(r, schemas.WORKLIST) for r in (rows, staged))
    got = {r.part: tuple(r)[1:] for r in worklist.fill_status_by_partition(main, staging).collect()}
    assert got == {part: tuple(worklist.fill_status(main, staging, part).first()) for part in (-1, 0, 1, 2)}


def test_pending(spark):
    main = _worklist(
        spark, ("a", None, None, None, 0, 0), ("b", None, None, None, 1, 0), ("c", None, None, None, 0, 1),
        ("d", None, None, None, None, 0), ("e", None, None, None, 0, 0), ("f", None, None, None, 0, 0),
    )
    blank = (None, None, None, 0)
    staging = _worklist(spark, ("a", *blank, 2), ("e", *blank, 0), ("f", *blank, None))
    assert _rows(worklist.pending(main, staging), "id") == [("b",), ("e",)]
    assert _rows(worklist.pending(main, staging, 1), "id") == [("b",)]


def test_fill_status(spark):
    main = _worklist(
        spark, ("a", None, None, None, 0, 0), ("b", None, None, None, 0, 2), ("c", None, None, None, 1, 1),
        ("d", None, None, None, 2, 0),
    )
    staging = _worklist(spark, ("a", "v", 1, 1, 0, 1), ("b", "v", 1, 1, 0, 1), ("c", "v", 1, 1, 1, 1))
    row = worklist.fill_status(main, staging).first()
    # a counts as filled and open, b as failed and filled, c once.
    assert (row.filled, row.unfilled, row.error, row.total, row.pending_net) == (3, 2, 1, 4, 1)
    assert row.eta == "0 hrs 00 min 06 sec"
    empty = worklist.fill_status(main.limit(0), staging.limit(0)).first()
    assert (empty.filled, empty.unfilled, empty.error, empty.total) == (0, 0, 0, 0)


def test_merge_and_reset(spark):
    main = _worklist(
        spark, ("a", None, None, None, 0, 0), ("b", "old", 1, 1, 1, 1), ("c", None, None, None, 2, None),
        ("d", None, None, None, None, 0),
    )
    others = [("x", None, None, None, 0, 2), ("y", None, None, None, 0, None)]
    staging = _worklist(spark, *[(i, "new", 9, 9, 0, 1) for i in "abc"], *others)
    assert _rows(worklist.merge_staging(main, staging).fillna("-").fillna(-1), "id", "venue", "filled") == [
        ("a", "new", 1), ("b", "old", 1), ("c", "-", -1), ("d", "-", 0),
    ]
    assert worklist.merged_count(staging).first()[0] == 4
    reset = worklist.reset_outside(main, 1).fillna("-").fillna(-1)
    assert _rows(reset, "id", "venue", "year", "filled") == [
        ("a", "-", -1, 0), ("b", "old", 1, 1), ("c", "-", -1, 0), ("d", "-", -1, 0),
    ]


OK = {"venue": "V", "year": 2020, "citationCount": 3}


@pytest.mark.parametrize(
    "status, body, state",
    [
        (200, json.dumps(OK), schemas.DONE),
        (200, json.dumps({**OK, "year": None}), schemas.DONE),
        (200, json.dumps({**OK, "error": None}), schemas.DONE),
        (500, json.dumps(OK), schemas.DONE),
        (200, json.dumps({"venue": "V", "year": 1}), schemas.ERROR),
        (403, json.dumps({"message": "Forbidden"}), schemas.TODO),
        (403, "<html>no</html>", schemas.ERROR),
        (404, json.dumps({"error": "not found"}), schemas.ERROR),
        (200, json.dumps({**OK, "error": "x"}), schemas.ERROR),
        (200, json.dumps({**OK, "venue": ["V"]}), schemas.ERROR),
        (200, json.dumps({**OK, "year": {"y": 1}}), schemas.ERROR),
        (200, json.dumps({**OK, "year": "2020"}), schemas.DONE),
        (200, "[1]", schemas.ERROR),
        (200, "null", schemas.ERROR),
        (403, "[1]", schemas.TODO),
        (200, "", schemas.ERROR),
        (200, None, schemas.ERROR),
    ],
)
def test_response_state(spark, status, body, state):
    df = spark.createDataFrame([("a", status, body)], schemas.RESPONSES)
    assert complete.with_state(df).first()["state"] == state


def test_complete(spark):
    pending = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2), ("d", 0), ("e", 0)], "id STRING, partition INT")
    responses = [
        ("a", 200, json.dumps(OK)), ("b", 404, '{"error": "x"}'), ("c", 403, "{}"), ("z", 200, json.dumps(OK)),
        ("e", 403, "{}"), ("e", 200, json.dumps({**OK, "venue": None})),
    ]
    got = complete.complete(pending, spark.createDataFrame(responses, schemas.RESPONSES))
    assert {r.id: tuple(r)[1:] for r in got.collect()} == {
        "a": ("V", 2020, 3, 0, 1), "b": (None, None, None, 1, 2), "e": (None, 2020, 3, 0, 1),
    }


def test_completed_papers(spark):
    raw = spark.createDataFrame(
        [(i, "t", "a", None, [["Doe", "Jane"]]) for i in ("n", "e", "v", "v", "open")], schemas.CATEGORY_PAPERS
    )
    main = _worklist(spark, ("n", None, 1, 1, 0, 1), ("e", "", 1, 1, 0, 1), ("v", "V", 1, 1, 0, 1), ("open", "V", 1, 1, 0, 0))
    got = complete.completed_papers(raw, main)
    assert Counter(r.id for r in got.collect()) == {"n": 1, "v": 2}
    assert "authors_parsed" not in got.columns and got.first().authors == ["Jane Doe"]


def test_checklist(spark):
    manifest = spark.createDataFrame([("s1",), ("s2",), ("s2",), ("s3",)], "partition STRING")
    existing = spark.createDataFrame([("s1", 1)], schemas.CHECKLIST)
    listed = worklist.init_checklist(manifest, existing)
    assert _rows(listed, "partition", "is_checked") == [("s1", 1), ("s2", 0), ("s3", 0)]
    ticked = worklist.mark_checked(listed, manifest.filter("partition = 's2'"))
    assert _rows(worklist.checked(ticked), "partition") == [("s1",), ("s2",)]
    assert _rows(worklist.unchecked(ticked), "partition") == [("s3",)]


# --- variants and masks -------------------------------------------------------------------------------


def _records(spark, n, prefix):
    rows = [(i, f"{prefix}{i}", f"{prefix} title {i}", f"{prefix} abs", f"{prefix} venue", [prefix], 2000, 5) for i in range(n)]
    return spark.createDataFrame(rows, schemas.PAPER_RECORD)


@pytest.mark.parametrize("inline_seeds", [64, 1])
def test_text_variants(spark, inline_seeds):
    seeds, sources = _records(spark, 3, "seed"), _records(spark, 5, "src")
    got = variant.text_variants(seeds, sources, "x", inline_seeds).collect()
    expected = Counter()
    for seed in seeds.collect():
        for source in sources.collect():
            for f in ("title", "abstract", "venue", "authors"):
                record = {**seed.asDict(), f: source[f]}
                expected[(seed.id, f, json.dumps(record))] += 1
    fields = schemas.PAPER_RECORD.fieldNames()
    assert Counter((r.seed_id, r.feature, json.dumps({k: r[k] for k in fields})) for r in got) == expected
    assert len(got) == 60


def test_sweeps(spark):
    seeds = _records(spark, 3, "seed")
    years = variant.sweep_variants(seeds, "year", "x")
    assert (years.count(), years.agg(F.min("year"), F.max("year")).first()) == (6_150, (0, 2_049))
    citations = variant.sweep_variants(seeds, "n_citations", "x")
    assert citations.agg(F.count("*"), F.max("n_citations")).first() == (30_000, 9_999)
    assert citations.first().feature == "citation" and citations.first().year == 2000
    assert variant.all_variants(seeds, _records(spark, 2, "src"), "x").count() == 3 * (4 * 2 + 2_050 + 10_000)


def test_masks(spark):
    record = ("7", "t", "a", None, ["x", "y"], 2001, None, 4)
    df = spark.createDataFrame([record], schemas.COMPLETED_RECORD).select(
        "id", "title", "abstract", "venue", "authors", "year", "n_citations"
    )
    values = {"authors": [], "n_citations": 0}
    source = df.first().asDict()
    got = {r.masking: json.loads(r.value) for r in mask.mask_features(df).collect()}
    for name in ("title", "abstract", "venue", "authors", "year", "n_citations", "full"):
        masked = dict(source) if name == "full" else {**source, name: values.get(name, " ")}
        del masked["id"]
        assert got[name] == {k: v for k, v in masked.items() if v is not None}, name
    assert got["year"]["year"] == " " and got["full"]["year"] == 2001
