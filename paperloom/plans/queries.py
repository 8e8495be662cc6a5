"""Registered queries: every operator over the given tables, with scalar result columns."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom import registry as reg
from paperloom import schemas, session
from paperloom.functions import text
from paperloom.operators import complete, counts, export, extract, mask, match, sample, topic_index, variant, worklist
from paperloom.plans import testdata as data
from paperloom.plans.commands import Layout, ingest_corpus, latest
from paperloom.sources import buckets, readers, versions, writers
from paperloom.streaming import completion

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY = reg.default_registry()
LABELS = reg.second_level(REGISTRY)
TOPIC = "and( |-)the"
SEED = 42


# --- projections and filters --------------------------------------------------------------------------


def category_filter(spark, sf_dir):
    papers = extract.in_category(data.snapshot(spark, sf_dir), reg.category("cspl"))
    return papers.select("id", "title", "categories")


def category_labels(spark, sf_dir):
    return extract.label_papers(data.snapshot(spark, sf_dir), REGISTRY).select("id", "cate")


def category_count(spark, sf_dir):
    return extract.category_count(data.snapshot(spark, sf_dir), reg.category("cslg"))


def topic_filter(spark, sf_dir):
    return extract.in_topic(data.papers(spark, sf_dir), TOPIC).select("id", "title", "abstract")


def _indexed_corpus(spark, sf_dir):
    """The corpus as ingestion leaves it, and the trigram index of its checked shards."""
    path = _scratch(spark, "topics")
    papers = data.papers(spark, sf_dir).select("id", "title", "abstract", "partition")
    papers.hint("rebalance", "partition").sortWithinPartitions("partition", "id").write.partitionBy("partition").parquet(f"{path}/papers")
    stored = spark.read.schema(papers.schema).parquet(f"{path}/papers")
    checked = worklist.checked(shard_checklist(spark, sf_dir))
    topic_index.write_postings(topic_index.postings(stored.join(F.broadcast(checked), "partition", "left_semi")), f"{path}/index")
    return stored, readers.read_table(spark, f"{path}/index", topic_index.SCHEMA)


def topic_filter_indexed(spark, sf_dir):
    """Same result as `topic_filter` from the trigram index; shards that are not in it are searched as a whole."""
    papers, index = _indexed_corpus(spark, sf_dir)
    return topic_index.in_topic_by_shards(papers, index, TOPIC).select("id", "title", "abstract")


def topic_candidates(spark, sf_dir):
    """Granules of the indexed shards that a search for the topic reads."""
    _, index = _indexed_corpus(spark, sf_dir)
    return topic_index.candidates(index, TOPIC)


def topic_count(spark, sf_dir):
    return extract.topic_count(data.papers(spark, sf_dir), TOPIC)


def drop_columns(spark, sf_dir):
    kept = extract.category_papers(data.snapshot(spark, sf_dir), reg.category("cs"))
    return kept.select(
        "id",
        "title",
        "abstract",
        F.col("report-no").alias("report_no"),
        F.to_json("authors_parsed").alias("authors_parsed"),
        F.lit(" ".join(sorted(kept.columns))).alias("kept"),
    )


def completeness_filter(spark, sf_dir):
    return data.gappy_papers(spark, sf_dir).filter(extract.is_complete()).drop("s2_id", "authors")


def extract_topic(spark, sf_dir):
    """All ids of a topic with the numbers that are reported beside them."""
    papers = data.papers(spark, sf_dir)
    ids = extract.pick(extract.in_topic(papers, TOPIC).select("id").distinct(), None, SEED)
    counted = extract.topic_count(papers, TOPIC).first()
    numbers = {"matched": counted.matched, "total": counted.total, "picked": ids.count()}
    return ids.withColumns({name: F.lit(n).cast("bigint") for name, n in numbers.items()})


def array_membership(spark, sf_dir):
    shaped = extract.reshape_shard_records(data.shard_records(spark, sf_dir))
    return shaped.withColumn("authors", F.array_join("authors", "|"))


def author_names(spark, sf_dir):
    named = extract.completed_authors(data.snapshot(spark, sf_dir))
    return named.select("id", F.array_join("authors", "|").alias("authors"))


def authors_decode(spark, sf_dir):
    encoded = data.papers(spark, sf_dir).select("id", F.to_json("authors").alias("line"))
    return encoded.select("id", F.posexplode(text.decode_string_array(F.col("line"))).alias("pos", "author"))


def drop_null_fields(spark, sf_dir):
    rows = extract.ragged_json(data.gappy_papers(spark, sf_dir).drop("s2_id", "authors"))
    keys = F.explode(F.json_object_keys("value"))
    parsed = rows.select(keys.alias("field"), F.from_json("value", "map<string, string>").alias("fields"))
    return parsed.select(
        F.col("fields")["id"].cast("bigint").alias("id"),
        "field",
        F.element_at("fields", F.col("field")).alias("value"),
    )


def title_key(spark, sf_dir):
    papers = data.corpus_titles(spark, sf_dir)
    return papers.select("id", text.title_key(F.col("title")).alias("title_key"))


def derived_names(spark, sf_dir):
    """Names built from the parts of each page's address."""
    pages = data.table(spark, sf_dir, "pages")
    host, lang = F.split_part("url", F.lit("/"), F.lit(3)), F.split_part("url", F.lit("/"), F.lit(4))
    ending = F.element_at(F.array(F.lit(".json.gz"), F.lit(".gz"), F.lit("")), (F.col("page_id") % 3 + 1).cast("int"))
    return pages.select(
        "page_id",
        text.shard_name(F.concat(text.base_name(F.col("url")), F.lit("."), lang, ending)).alias("shard"),
        text.source_label(F.concat(F.lit("/a/completed_s2_arxiv_"), host, F.lit("_all_.data"))).alias("source"),
        text.worklist_category(F.concat(lang, F.lit("_"), host)).alias("cate"),
    )


def audit_cleanup(spark, sf_dir):
    """Titles of several lines and double blanks on one line: whole texts with each blank doubled."""
    titles = data.table(spark, sf_dir, "documents").select("doc_id", F.replace("text", F.lit(" "), F.lit("  ")).alias("t"))
    return titles.select(
        "doc_id", text.audit_title(F.col("t"), True).alias("a_title"), text.audit_title(F.col("t"), False).alias("s_title")
    )


def crc_tokens(spark, sf_dir):
    docs = data.table(spark, sf_dir, "documents").withColumn("token", text.crc_token(F.col("lang")))
    return docs.groupBy("lang", "token").agg(F.count("*").alias("n"))


# --- matching, labels, counts -------------------------------------------------------------------------


def _index(spark, sf_dir):
    snapshot = data.snapshot(spark, sf_dir)
    return session.durable(match.title_index(snapshot, LABELS, F.col("id").cast("bigint")))


def _matches(spark, sf_dir):
    return match.match_titles(_index(spark, sf_dir), data.corpus_titles(spark, sf_dir))


def title_match(spark, sf_dir):
    return _matches(spark, sf_dir).select("cate", "id", "arxiv_id")


def title_match_shuffled(spark, sf_dir):
    """Same result as `title_match` on the path for a long index, with every repeated key treated as hot."""
    titles = data.corpus_titles(spark, sf_dir)
    matches = match.match_titles(_index(spark, sf_dir), titles, hot_rows=2, broadcast_bytes=0)
    return matches.select("cate", "id", "arxiv_id")


def match_rate(spark, sf_dir):
    index = _index(spark, sf_dir)
    return match.match_rate(index, match.match_titles(index, data.corpus_titles(spark, sf_dir)), LABELS)


def match_audit(spark, sf_dir):
    return match.match_audit(_matches(spark, sf_dir))


def label_counts(spark, sf_dir):
    return counts.label_counts(match.label_index(_matches(spark, sf_dir)), LABELS)


def label_totals(spark, sf_dir):
    return counts.label_totals(label_counts(spark, sf_dir))


def corpus_count(spark, sf_dir):
    return counts.corpus_count(data.papers(spark, sf_dir))


def corpus_topic_count(spark, sf_dir):
    """Topic papers of the checked shards; a shard is checked if a labelled document comes from it."""
    papers = data.papers(spark, sf_dir)
    labelled = data.table(spark, sf_dir, "labels").filter("toxic = 1").select(F.col("doc_id").alias("id"))
    shards = papers.join(labelled, "id", "left_semi").select("partition").distinct()
    return counts.corpus_topic_count(papers, TOPIC, shards)


# --- exports and samples ------------------------------------------------------------------------------


def id_list_export(spark, sf_dir):
    orders = data.table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "id")
    ids = data.table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("id"))
    return export.by_ids(orders, ids).select("id", "o_custkey", "o_orderpriority")


def id_list_export_in_ranges(spark, sf_dir):
    """Same result as `id_list_export` for a list that is too long to be broadcast at once."""
    orders = data.table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "id")
    ids = data.table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("id"))
    size = 8 * ids.distinct().count()
    return export.by_ids(orders, ids, broadcast_bytes=max(16, size // 2)).select("id", "o_custkey", "o_orderpriority")


def id_list_export_bucketed(spark, sf_dir):
    """Same result as `id_list_export` from a table dealt out by id, which stays where it is."""
    path = _scratch(spark, "orders")
    orders = data.table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "id").select("id", "o_custkey", "o_orderpriority")
    buckets.write_bucketed(orders, path, "id", buckets.buckets_for(spark, orders.count()))
    ids = data.table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("id"))
    return buckets.by_ids_in_place(buckets.read_bucketed(spark, path), ids)


def label_export(spark, sf_dir):
    index = match.label_index(_matches(spark, sf_dir))
    papers = export.record_columns(export.of_label(data.papers(spark, sf_dir), index, "cspl"))
    return papers.withColumn("authors", F.array_join("authors", "|"))


def label_random_export(spark, sf_dir):
    index = session.durable(match.label_index(_matches(spark, sf_dir)))
    drawn = export.random_of_label(data.papers(spark, sf_dir), index, "cslg", 50, SEED)
    return drawn.select("id", "s2_id", "title", "abstract")


def dense_id(spark, sf_dir):
    return sample.dense_id(data.table(spark, sf_dir, "customer").select("c_custkey", "c_name"), "c_custkey", SEED)


def range_export(spark, sf_dir):
    numbered = sample.dense_id(data.table(spark, sf_dir, "orders"), "o_orderkey", SEED)
    return export.by_range(numbered, 100, 1_000).select("id", "o_orderkey", "o_orderpriority")


def paged_export(spark, sf_dir):
    numbered = sample.dense_id(data.table(spark, sf_dir, "orders"), "o_orderkey", SEED)
    return numbered.select("id", "o_orderkey", export.page_of(F.col("id"), 1_000).alias("page"))


def random_sample(spark, sf_dir):
    orders = data.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return sample.sample(orders, "o_orderkey", 1_000, SEED)


def label_sample(spark, sf_dir):
    return sample.sample(category_labels(spark, sf_dir), "id", 20, SEED, by=["cate"])


def label_sample_joined(spark, sf_dir):
    """Same result as `label_sample` with the cuts joined by a shuffle, as for very many groups."""
    return sample.sample(category_labels(spark, sf_dir), "id", 20, SEED, by=["cate"], max_cut_rows=2)


def three_way_split(spark, sf_dir):
    return sample.three_way_split(data.table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", SEED)


# --- work-list ----------------------------------------------------------------------------------------


def _comparable(rows: DataFrame) -> DataFrame:
    """Nullable numbers as text, so that results look alike however an engine represents a missing number."""
    return rows.withColumns({c: F.col(c).cast("string") for c in ("year", "n_citations", "partition")})


def insert_or_ignore(spark, sf_dir):
    existing = data.worklist(spark, sf_dir).filter("filled = 1")
    new = data.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("id"))
    return worklist.insert_or_ignore(existing, new)


def create_worklist(spark, sf_dir):
    existing = data.worklist(spark, sf_dir).filter("filled = 1")
    ids = data.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("id"))
    return _comparable(worklist.create_worklist(ids, existing, SEED))


def pending_work(spark, sf_dir):
    return worklist.pending(data.worklist(spark, sf_dir), data.staging(spark, sf_dir))


def fill_status(spark, sf_dir):
    return worklist.fill_status_by_partition(data.worklist(spark, sf_dir), data.staging(spark, sf_dir))


def eta(spark, sf_dir):
    orders = data.table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", text.eta(F.col("o_orderkey")).alias("eta"))


def classify_responses(spark, sf_dir):
    return complete.with_state(data.responses(spark, sf_dir)).select("id", "state")


def complete_staging(spark, sf_dir):
    responses = data.repeated_responses(spark, sf_dir)
    return _comparable(complete.complete(pending_work(spark, sf_dir), responses))


def complete_staging_stream(spark, sf_dir):
    """Same result as `complete_staging` from responses that arrive in three parts, each taken up by a run of its own.

    The parts are made by a hash of the whole response, so the responses of a paper arrive in any order, some late.
    """
    path = _scratch(spark, "completion")
    part = F.pmod(F.xxhash64("id", "status", "body"), F.lit(3))
    responses = data.repeated_responses(spark, sf_dir)
    for n in range(3):
        responses.filter(part == n).write.mode("append").json(f"{path}/responses")
        completion.settle(spark, f"{path}/responses", f"{path}/outcomes", f"{path}/checkpoint")
    pending = pending_work(spark, sf_dir)
    settled = completion.outcomes(spark, f"{path}/outcomes")
    return _comparable(completion.staged(pending, settled))


def merge_staging(spark, sf_dir):
    return _comparable(worklist.merge_staging(data.worklist(spark, sf_dir), data.repeated_staging(spark, sf_dir)))


def merge_staging_bucketed(spark, sf_dir):
    """Same result as `merge_staging` from a work-list dealt out by id, which stays where it is."""
    path = _scratch(spark, "worklist")
    main = data.worklist(spark, sf_dir)
    buckets.write_bucketed(main, path, "id", buckets.buckets_for(spark, main.count()))
    return _comparable(worklist.merge_staging(buckets.read_bucketed(spark, path), data.repeated_staging(spark, sf_dir)))


def state_changes(spark, sf_dir):
    """The work-list after a merge and a reset, each committed as a change set and read back over the base."""
    path = _scratch(spark, "versions")
    versions.commit_changes(data.worklist(spark, sf_dir), path, -1, schemas.WORKLIST, most_changes=0)
    main, number = versions.read_version(spark, path, schemas.WORKLIST)
    versions.commit_changes(worklist.merged_rows(main, data.repeated_staging(spark, sf_dir)), path, number, schemas.WORKLIST)
    main, number = versions.read_version(spark, path, schemas.WORKLIST)
    versions.commit_changes(worklist.reset_rows(main, 1), path, number, schemas.WORKLIST)
    return _comparable(versions.read_version(spark, path, schemas.WORKLIST)[0])


def merged_count(spark, sf_dir):
    return worklist.merged_count(data.staging(spark, sf_dir))


def reset_partition(spark, sf_dir):
    return _comparable(worklist.reset_outside(data.worklist(spark, sf_dir), 1))


def complete_join(spark, sf_dir):
    done = data.worklist(spark, sf_dir)
    papers = complete.completed_papers(extract.drop_unused(data.snapshot(spark, sf_dir)), done)
    return papers.select("id", "title", F.array_join("authors", "|").alias("authors"), "year", "venue", "n_citations")


def shard_checklist(spark, sf_dir):
    """Shards of French toxic texts are on the list already, as checked; an old row wins over a new one."""
    documents = data.table(spark, sf_dir, "documents").withColumnRenamed("source", "partition")
    toxic = data.table(spark, sf_dir, "labels").filter("toxic = 1").select("doc_id")
    existing = documents.filter("lang = 'fr'").join(toxic, "doc_id", "left_semi").select("partition").distinct().withColumn("is_checked", F.lit(1))
    done = documents.filter("lang = 'de' AND n_chars > 3000").select("partition")
    return worklist.mark_checked(worklist.init_checklist(documents, existing), done)


def unchecked_shards(spark, sf_dir):
    return worklist.unchecked(shard_checklist(spark, sf_dir))


# --- variants and masks -------------------------------------------------------------------------------


def variant_text(spark, sf_dir):
    variants = variant.text_variants(data.seeds(spark, sf_dir, "region"), data.papers(spark, sf_dir), "documents")
    return variants.withColumn("authors", F.array_join("authors", "|"))


def variant_text_fragmented(spark, sf_dir):
    """Same result as `variant_text` on the path for many seeds; a key the papers do not have is carried over."""
    seeds = data.seeds(spark, sf_dir, "region").withColumn("note", F.concat(F.lit("n"), "id"))
    variants = variant.text_variants(seeds, data.papers(spark, sf_dir), "documents", inline_seeds=2)
    return variants.withColumn("authors", F.array_join("authors", "|"))


def _sweep(spark, sf_dir, field):
    swept = variant.sweep_variants(data.seeds(spark, sf_dir, "benchmark"), field, "documents")
    return swept.withColumn("authors", F.array_join("authors", "|"))


def variant_year(spark, sf_dir):
    return _sweep(spark, sf_dir, "year")


def variant_citations(spark, sf_dir):
    return _sweep(spark, sf_dir, "n_citations")


def mask_features(spark, sf_dir):
    papers = data.gappy_papers(spark, sf_dir)
    # One parse per record: every field as text, which also shows that a masked year is no number.
    fields = F.from_json("value", "map<string, string>").alias("f")
    parsed = mask.mask_features(papers).select("masking", fields)
    field = {c: F.try_element_at("f", F.lit(c)) for c in ("s2_id", "title", "abstract", "venue", "year")}
    return parsed.select(
        "masking",
        *[value.alias(c) for c, value in field.items()],
        F.try_element_at("f", F.lit("n_citations")).cast("int").alias("n_citations"),
        F.array_join(text.decode_string_array(F.try_element_at("f", F.lit("authors"))), "|").alias("authors"),
        F.size("f").cast("bigint").alias("n_keys"),
    )


# --- sinks read back, ingestion -----------------------------------------------------------------------


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{session.shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def records_sink(spark, sf_dir):
    path = _scratch(spark, "records")
    writers.write_records(export.record_columns(data.papers(spark, sf_dir)), path)
    return readers.read_records(spark, path).withColumn("authors", F.array_join("authors", "|"))


def category_sink(spark, sf_dir):
    path = _scratch(spark, "category")
    labelled = extract.label_papers(data.snapshot(spark, sf_dir), REGISTRY)
    writers.write_category_papers(extract.drop_unused(labelled), path)
    papers = spark.read.schema(schemas.plus(schemas.CATEGORY_PAPERS, "cate", schemas.TEXT)).json(path)
    return papers.select("id", "cate", "title", "abstract", F.col("report-no").alias("report_no"))


def label_index_sink(spark, sf_dir):
    """The label index as a table and as text lists, counted side by side."""
    index, table, lines = match.label_index(_matches(spark, sf_dir)), _scratch(spark, "index"), _scratch(spark, "lines")
    writers.write_label_index(index, table)
    stored = readers.read_table(spark, table, schemas.LABEL_INDEX)
    writers.export_label_index(stored, lines)
    listed = readers.read_id_list(spark, lines).groupBy("id").agg(F.count("*").alias("n_listed"))
    return stored.groupBy("id").agg(F.count("*").alias("n_labels")).join(listed, "id")


def audit_sink(spark, sf_dir):
    path = _scratch(spark, "audit")
    writers.write_match_audit(match.match_audit(_matches(spark, sf_dir)), path)
    schema = "cate STRING, id BIGINT, categories STRING, a_title STRING, s_title STRING"
    return spark.read.schema(schema).json(path)


def variant_sink(spark, sf_dir):
    path = _scratch(spark, "variants")
    seeds = data.seeds(spark, sf_dir, "region")
    written = variant.text_variants(seeds, data.papers(spark, sf_dir), "documents")
    folders = seeds.select("id").distinct().count() * len(variant.TEXT_FEATURES)
    writers.write_variants(written, path, folders, writers.COMPRESSED)
    return spark.read.schema(written.schema).json(path).withColumn("authors", F.array_join("authors", "|"))


def masked_sink(spark, sf_dir):
    path = _scratch(spark, "masked")
    writers.write_masked(mask.mask_features(export.record_columns(data.papers(spark, sf_dir))), path, writers.COMPRESSED)
    lines = spark.read.schema("value STRING, masking STRING").text(path)
    schema = "s2_id STRING, title STRING, abstract STRING, venue STRING, authors ARRAY<STRING>, year STRING, n_citations INT"
    rows = lines.select("masking", F.from_json("value", schema).alias("r")).select("masking", "r.*")
    return rows.withColumn("authors", F.array_join("authors", "|"))


def completed_sink(spark, sf_dir):
    """Completed papers as written: which keys each has (a French one has no report number), and their values."""
    raw = extract.drop_unused(data.snapshot(spark, sf_dir).withColumn("report-no", F.when(F.col("authors") != "fr", F.col("submitter"))))
    path = _scratch(spark, "completed")
    writers.write_completed(complete.completed_papers(raw, data.worklist(spark, sf_dir)), path)
    fields = F.from_json("value", "map<string, string>")
    lines = spark.read.text(path).select(fields.alias("f"), F.array_join(F.array_sort(F.json_object_keys("value")), " ").alias("keys"))
    return lines.select("keys", *[F.col("f")[c].alias(c) for c in ("id", "title", "abstract", "authors", "year", "venue", "n_citations")])


# --- sources: written, then read by their readers -----------------------------------------------------


def snapshot_scan(spark, sf_dir):
    """Snapshot files with a key no schema names: it is kept, and so are the ones to be dropped later."""
    path = _scratch(spark, "snapshot")
    data.snapshot(spark, sf_dir).withColumn("extra", F.concat(F.lit("x"), "id")).write.json(path)
    return readers.read_snapshot(spark, path).select("id", "title", "abstract", "categories", "doi", "extra")


def _array_files(spark, sf_dir, layout, *further):
    """The papers as JSON array files of one layout, read again."""
    path = _scratch(spark, "array")
    papers = data.snapshot(spark, sf_dir).select("id", "title", "abstract", "authors_parsed", *further)
    writers.write_json_arrays(papers, path, layout=layout, rows_per_file=2_000)
    return readers.read_json_array(spark, path).withColumn("authors_parsed", F.to_json("authors_parsed"))


def json_array_scan(spark, sf_dir):
    """Arrays over all papers, an object per line."""
    return _array_files(spark, sf_dir, "lines")


def json_array_layouts(spark, sf_dir):
    """The same papers from arrays on one line and from pretty-printed ones."""
    one, two = (_array_files(spark, sf_dir, layout, "report-no").withColumn("layout", F.lit(layout)) for layout in ("one line", "pretty"))
    return one.unionByName(two).withColumnRenamed("report-no", "report_no")


def manifest_scan(spark, sf_dir):
    path = _scratch(spark, "manifest")
    shards = data.table(spark, sf_dir, "documents").select(F.concat(F.lit(" "), "source", F.lit(".json.gz ")).alias("value")).distinct()
    shards.unionByName(spark.sql("SELECT '' AS value")).write.text(path)
    return readers.read_manifest(spark, path)


def corpus_scan(spark, sf_dir):
    """The corpus table with some columns of the shards that are on the list of checked ones."""
    path = _scratch(spark, "corpus")
    papers = data.papers(spark, sf_dir).withColumn("title_key", text.title_key(F.col("title")))
    papers.write.partitionBy("partition").parquet(path)
    shards = worklist.checked(shard_checklist(spark, sf_dir))
    return readers.read_papers(spark, path, columns=("id", "title_key", "year", "partition"), shards=shards)


def responses_scan(spark, sf_dir):
    path = _scratch(spark, "responses")
    data.responses(spark, sf_dir).write.json(path)
    return readers.read_responses(spark, path)


def append_sink(spark, sf_dir):
    """Two appends of overlapping id lists keep one row per id."""
    path = _scratch(spark, "append")
    orders = data.table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("id"))
    lines = data.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("id"))
    nothing = spark.createDataFrame([], orders.schema)
    writers.append_new(lines, nothing, path)
    writers.append_new(orders, spark.read.schema(orders.schema).parquet(path), path)
    return spark.read.schema(orders.schema).parquet(path)


def unusable_counts(spark, sf_dir):
    """Titles are taken from records without a venue, abstracts from those without a year."""
    records = data.shard_records(spark, sf_dir).withColumns(
        {
            "title": F.when(F.col("venue") != "", F.col("title")),
            "paperAbstract": F.when(F.col("year").isNotNull(), F.col("paperAbstract")),
        }
    )
    return extract.unusable_counts(records)


def _land(spark, shards, staged, landing, name):
    """One compressed shard file per source; `name` gives a file's name and its age in days from the source."""
    shards.withColumn("source", F.col("partition")).drop("partition").repartition("source").write.partitionBy("source").option(
        "compression", "gzip"
    ).json(staged)
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    folder = hadoop_path(staged)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(hadoop_path(landing))
    for source in files.listStatus(folder):
        if not source.isDirectory():
            continue
        written = [f.getPath() for f in files.listStatus(source.getPath()) if f.getPath().getName().startswith("part-")]
        file_name, days = name(source.getPath().getName().partition("=")[2])
        (part,) = written
        target = hadoop_path(landing, file_name)
        files.rename(part, target)
        files.setTimes(target, files.getFileStatus(target).getModificationTime() - days * 86_400_000, -1)


def _third(spark, landing):
    """A third of the bytes of the landed files."""
    files = spark.read.format("binaryFile").load(landing)
    return max(1, files.agg(F.sum("length")).first()[0] // 3)


def incremental_ingest(spark, sf_dir):
    """One compressed shard per source, landed and ingested in two runs, each in batches of a third of the bytes landed.

    The second run's files are 30 days older and have a blank in their names. Returns the corpus with facts on the ids
    of each shard, and whether the checklist has it as checked.
    """
    layout = Layout(_scratch(spark, "ingest"))
    shards = data.shard_records(spark, sf_dir)
    odd = F.substring("partition", 4, 10).cast("int") % 2 == 1
    _land(spark, shards.filter(odd), f"{layout.base}/first", layout.landing, lambda s: (f"{s}.json.gz", 0))
    ingest_corpus(spark, layout, _third(spark, layout.landing))
    later = lambda s: (f"{s.replace('src', 'src ')}.v2.gz", 30)
    _land(spark, shards.filter(~odd), f"{layout.base}/second", layout.landing, later)
    ingest_corpus(spark, layout, _third(spark, layout.landing))
    papers = readers.read_papers(spark, layout.papers)
    facts = papers.groupBy("partition").agg(
        F.count("*").alias("shard_rows"), F.count_distinct("id").alias("shard_ids"), (F.max("id") - F.min("id") + 1).alias("shard_span")
    )
    ids = papers.agg(F.min("id").alias("first_id"), F.max("id").alias("last_id"), F.count_distinct("id").alias("n_ids")).first()
    checklist, _ = latest(spark, layout.checklist, schemas.CHECKLIST)
    rows = papers.drop("id").join(facts, "partition").join(checklist, "partition", "left")
    return rows.withColumn("authors", F.array_join("authors", "|")).withColumns(
        {name: F.lit(ids[name]).cast("bigint") for name in ("first_id", "last_id", "n_ids")}
    )


REGISTERED: dict[str, Query] = {
    query.__name__: query
    for query in (
        category_filter, category_labels, category_count, topic_filter, topic_filter_indexed, topic_candidates, topic_count, drop_columns,
        completeness_filter, extract_topic, array_membership, author_names, authors_decode, drop_null_fields, title_key,
        derived_names, audit_cleanup, crc_tokens, title_match, title_match_shuffled, match_rate, match_audit, label_counts, label_totals,
        corpus_count, corpus_topic_count, id_list_export, id_list_export_in_ranges, id_list_export_bucketed, label_export, label_random_export, dense_id,
        range_export, paged_export, random_sample, label_sample, label_sample_joined, three_way_split, insert_or_ignore,
        create_worklist, pending_work, fill_status, eta, classify_responses, complete_staging, complete_staging_stream, merge_staging, merge_staging_bucketed, state_changes,
        merged_count, reset_partition, complete_join, shard_checklist, unchecked_shards, variant_text, variant_text_fragmented,
        variant_year, variant_citations, mask_features, records_sink, category_sink, label_index_sink, audit_sink,
        variant_sink, masked_sink, completed_sink, append_sink, snapshot_scan, json_array_scan, json_array_layouts, manifest_scan,
        corpus_scan, responses_scan, unusable_counts, incremental_ingest,
    )
}
