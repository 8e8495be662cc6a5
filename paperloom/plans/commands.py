"""The jobs a user runs, one function per command, over one folder layout.

Mutable tables (work-list, checklist) are kept as a base and change sets: a job reads the newest state and writes the rows it
changes. A change counts once its write has left its success mark, so a failed job leaves the old state in place.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paperloom import registry as reg
from paperloom import schemas
from paperloom.functions.text import source_label, worklist_category
from paperloom.operators import complete as complete_ops
from paperloom.operators import counts, export, extract, mask, match, topic_index, variant, worklist
from paperloom.session import durable
from paperloom.sources import readers, writers
from paperloom.sources.versions import changed_rows, commit_changes, read_version
from paperloom.streaming import completion
from paperloom.streaming.ingest import BYTES_PER_BATCH, ingest, passed_over, shards_read


@dataclass(frozen=True)
class Layout:
    """Folders below one base path."""

    base: str

    def _at(self, *parts: str) -> str:
        return "/".join([self.base.rstrip("/"), *parts])

    @property
    def snapshot(self) -> str:
        return self._at("snapshot")

    @property
    def manifest(self) -> str:
        return self._at("manifest")

    @property
    def landing(self) -> str:
        return self._at("landing")

    @property
    def papers(self) -> str:
        return self._at("papers")

    @property
    def chunks(self) -> str:
        return self._at("papers_chunks")

    @property
    def ingest_checkpoint(self) -> str:
        return self._at("ingest_checkpoint")

    @property
    def checklist(self) -> str:
        return self._at("checklist")

    @property
    def index(self) -> str:
        return self._at("index")

    @property
    def topic_index(self) -> str:
        return self._at("topic_index")

    def category(self, name: str) -> str:
        return self._at("category", f"cate={name}")

    def worklist(self, name: str) -> str:
        return self._at("worklist", name)

    def staging(self, name: str) -> str:
        return self._at("staging", name)

    def outcomes(self, name: str) -> str:
        return self._at("outcomes", name)

    def responses(self, name: str) -> str:
        return self._at("responses", name)

    @property
    def audits(self) -> str:
        return self._at("audit")

    def audit(self, cate: str) -> str:
        return f"{self.audits}/cate={cate}"

    def export(self, name: str) -> str:
        return self._at("export", name)


def latest(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, int]:
    """Newest finished state of a small mutable table and its number; an empty table and -1 if there is none."""
    return read_version(spark, path, schema)


def _read_category(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    path = layout.category(name)
    return spark.read.schema(readers.with_further_keys(spark, path, schemas.CATEGORY_PAPERS)).json(path)


def _worklist(spark: SparkSession, layout: Layout, name: str) -> tuple[DataFrame, int]:
    return latest(spark, layout.worklist(name), schemas.WORKLIST)


def _staging(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    """Staging rows of both ways of completion: those that jobs have appended, and those that the stream has settled."""
    appended = readers.read_table_or_empty(spark, layout.staging(name), schemas.WORKLIST)
    main, _ = _worklist(spark, layout, name)
    return appended.unionByName(completion.staged(main, completion.outcomes(spark, layout.outcomes(name))))


# --- categories, topics, completion -------------------------------------------------------------------


# A registry of the caller's own, or None for the default one; every job that uses labels takes it.
Registry = list[reg.Category] | None


def extract_category(spark: SparkSession, layout: Layout, cate: str, registry: Registry = None) -> None:
    papers = extract.category_papers(readers.read_snapshot(spark, layout.snapshot), reg.category(cate, registry))
    papers.write.mode("overwrite").json(layout.category(cate))


def extract_topic(
    spark: SparkSession, layout: Layout, cate: str, topic: str, seed: int = 0, store: bool = False, limit: int | None = None,
    registry: Registry = None,
) -> DataFrame:
    """Ids of a topic's papers, `limit` random ones or all; `store` puts them into the work-list.

    The ids go to the export folder. Returns one row: matched and total papers, and ids picked.
    """
    regex = reg.topic_regex(cate, topic, registry)
    if not readers.exists(spark, layout.category(cate)):
        extract_category(spark, layout, cate, registry)
    papers = _read_category(spark, layout, cate)
    # The regex scan is the costly part and sampling reads its input twice: keep the narrow id list.
    ids = extract.pick(durable(extract.in_topic(papers, regex).select("id").distinct()), limit, seed)
    name = f"{cate}_{topic}"
    path = layout.export(f"ids_{name}")
    ids.write.mode("overwrite").parquet(path)
    ids = readers.read_table(spark, path, ids.schema)
    if store:
        existing, version = _worklist(spark, layout, name)
        commit_changes(worklist.new_rows(ids, existing, seed), layout.worklist(name), version, schemas.WORKLIST)
    return extract.topic_count(papers, regex).withColumn("picked", F.lit(ids.count()))


def topic_count(spark: SparkSession, layout: Layout, cate: str, topic: str, registry: Registry = None) -> DataFrame:
    return extract.topic_count(_read_category(spark, layout, cate), reg.topic_regex(cate, topic, registry))


def fill_data(spark: SparkSession, layout: Layout, name: str, partition: int) -> None:
    """Settle pending papers from the fetched responses; results go to staging."""
    main, _ = _worklist(spark, layout, name)
    open_rows = worklist.pending(main, _staging(spark, layout, name), partition)
    settled = complete_ops.complete(open_rows, readers.read_responses(spark, layout.responses(name)))
    # Appending to a folder the plan reads is safe: its files were listed when the plan was made.
    settled.write.mode("append").parquet(layout.staging(name))


def fill_data_stream(
    spark: SparkSession, layout: Layout, name: str, bytes_per_batch: int = completion.BYTES_PER_BATCH
) -> DataFrame:
    """Settle papers from the responses that have arrived since the last run; returns the status of the whole list.

    The state of each paper is kept, so only new responses are read, whatever their order and however often they come.
    """
    path = layout.outcomes(name)
    completion.settle(spark, layout.responses(name), path, f"{path}/checkpoint", bytes_per_batch)
    return fill_status(spark, layout, name, worklist.ALL_PARTITIONS)


def fill_status(spark: SparkSession, layout: Layout, name: str, partition: int) -> DataFrame:
    main, _ = _worklist(spark, layout, name)
    return worklist.fill_status(main, _staging(spark, layout, name), partition)


def merge_data(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    main, version = _worklist(spark, layout, name)
    staging = _staging(spark, layout, name)
    merged = worklist.merged_count(staging)
    commit_changes(worklist.merged_rows(main, staging), layout.worklist(name), version, schemas.WORKLIST)
    return merged


def clear_partition(spark: SparkSession, layout: Layout, name: str, keep: int) -> None:
    main, version = _worklist(spark, layout, name)
    commit_changes(worklist.reset_rows(main, keep), layout.worklist(name), version, schemas.WORKLIST)


def export_data(spark: SparkSession, layout: Layout, name: str) -> None:
    main, _ = _worklist(spark, layout, name)
    cate = spark.range(1).select(worklist_category(F.lit(name))).first()[0]
    completed = complete_ops.completed_papers(_read_category(spark, layout, cate), main)
    writers.write_completed(completed, layout.export(f"completed_{name}.data"))


# --- corpus -------------------------------------------------------------------------------------------


def init_corpus(spark: SparkSession, layout: Layout) -> None:
    existing, version = latest(spark, layout.checklist, schemas.CHECKLIST)
    shards = readers.read_manifest(spark, layout.manifest)
    known = worklist.init_checklist(shards, existing)
    commit_changes(changed_rows(known, existing), layout.checklist, version, schemas.CHECKLIST)


def ingest_corpus(spark: SparkSession, layout: Layout, bytes_per_batch: int = BYTES_PER_BATCH) -> DataFrame:
    """Ingest new shards and check those that were read.

    Returns one row: shards landed, read and left unread (they stay unchecked), and records read and passed over.
    """
    landed = ingest(spark, layout.landing, layout.papers, layout.chunks, layout.ingest_checkpoint, bytes_per_batch)
    read = shards_read(spark, layout.chunks)
    checklist, version = latest(spark, layout.checklist, schemas.CHECKLIST)
    known = worklist.init_checklist(landed.union(read).distinct(), checklist)
    commit_changes(changed_rows(worklist.mark_checked(known, read), checklist), layout.checklist, version, schemas.CHECKLIST)
    both = landed.withColumn("landed", F.lit(1)).join(read.withColumn("read", F.lit(1)), "partition", "full")
    shards = both.agg(
        F.count("landed").alias("shards_landed"), F.count("read").alias("shards_read"),
        F.count_if(F.col("read").isNull()).alias("shards_unread"),
    ).first()
    counted = passed_over(spark, layout.chunks)
    return counted.select(*[F.lit(n).alias(name) for name, n in shards.asDict().items()], *counted.columns)


def corpus_count(spark: SparkSession, layout: Layout) -> DataFrame:
    return counts.corpus_count(readers.read_papers(spark, layout.papers))


def index_topics(spark: SparkSession, layout: Layout) -> DataFrame:
    """Add the shards that are new since the last run to the trigram index; returns how many shards it has."""
    papers = readers.read_papers(spark, layout.papers, columns=("id", "title", "abstract", "partition"))
    indexed = _topic_index(spark, layout).select("partition").distinct()
    topic_index.write_postings(topic_index.postings(papers.join(F.broadcast(indexed), "partition", "left_anti")), layout.topic_index)
    return _topic_index(spark, layout).agg(F.count_distinct("partition").alias("shards"))


def _topic_index(spark: SparkSession, layout: Layout) -> DataFrame:
    return readers.read_table_or_empty(spark, layout.topic_index, topic_index.SCHEMA)


def corpus_topic_count(spark: SparkSession, layout: Layout, topic: str, registry: Registry = None) -> DataFrame:
    """Papers of a topic in the checked shards. Of shards in the trigram index only what may match is read."""
    checklist, _ = latest(spark, layout.checklist, schemas.CHECKLIST)
    regex = reg.topic_regex(reg.UMBRELLA.name, topic, registry)
    papers, shards = readers.read_papers(spark, layout.papers), worklist.checked(checklist)
    if not readers.exists(spark, layout.topic_index):
        return counts.corpus_topic_count(papers, regex, shards)
    narrow = papers.select("id", "title", "abstract", "partition")
    return counts.count_in_shards(topic_index.in_topic_by_shards(narrow, _topic_index(spark, layout), regex), shards)


def _export(papers: DataFrame, layout: Layout, name: str) -> str:
    path = layout.export(name)
    writers.write_records(export.record_columns(papers), path)
    return path


def export_range(spark: SparkSession, layout: Layout, first: int, amount: int) -> str:
    """`first` is 1-based."""
    papers = readers.read_papers(spark, layout.papers)
    return _export(export.by_range(papers, first - 1, amount), layout, export.range_name(first - 1, amount))


def export_random(spark: SparkSession, layout: Layout, seed: int = 0, amount: int = export.RANDOM_EXPORT) -> str:
    papers = readers.read_papers(spark, layout.papers)
    token = export.crc_token(F.lit(str(seed)))
    token = spark.range(1).select(token).first()[0]
    return _export(export.random_papers(papers, seed, amount), layout, f"completed_s2_rand.{token}.data")


def export_from_ids(spark: SparkSession, layout: Layout, ids_path: str) -> str:
    ids = readers.read_id_list(spark, ids_path)
    name = ids_path.rstrip("/").rsplit("/", 1)[-1]
    papers = readers.read_papers(spark, layout.papers)
    return _export(export.by_ids(papers, ids), layout, f"completed_s2_with_id.{name}.data")


def _match(spark: SparkSession, layout: Layout, labels: list[reg.Category]) -> tuple[DataFrame, DataFrame]:
    """Title index of the labels and its matches in the checked shards, both computed once and kept."""
    snapshot = readers.read_snapshot(spark, layout.snapshot, schemas.SNAPSHOT)
    index = durable(match.title_index(snapshot, labels))
    checklist, _ = latest(spark, layout.checklist, schemas.CHECKLIST)
    titles = readers.read_papers(spark, layout.papers, columns=("id", "title", "title_key", "partition"))
    # The checklist holds one row per shard file; the planner broadcasts it and prunes the other shards.
    titles = titles.join(worklist.checked(checklist), "partition", "left_semi").drop("partition")
    return index, durable(match.match_titles(index, titles))


def match_label(spark: SparkSession, layout: Layout, cate: str, registry: Registry = None) -> DataFrame:
    """Match one label's snapshot papers with the corpus; writes index and audit, returns the match rate."""
    labels = [reg.category(cate, registry)]
    index, matches = _match(spark, layout, labels)
    writers.write_one_label(match.label_index(matches), layout.index, cate)
    match.match_audit(matches).drop("cate").write.mode("overwrite").json(layout.audit(cate))
    return match.match_rate(index, matches, labels)


def match_labels(spark: SparkSession, layout: Layout, registry: Registry = None) -> DataFrame:
    """Match all second-level labels in one pass over the corpus; replaces the whole index and audit."""
    labels = reg.second_level(registry or reg.default_registry())
    index, matches = _match(spark, layout, labels)
    writers.write_label_index(match.label_index(matches), layout.index)
    writers.write_match_audit(match.match_audit(matches), layout.audits)
    return match.match_rate(index, matches, labels)


def _label_index(spark: SparkSession, layout: Layout) -> DataFrame:
    return readers.read_table_or_empty(spark, layout.index, schemas.LABEL_INDEX)


def export_label(
    spark: SparkSession, layout: Layout, cate: str, amount: int | None = None, seed: int = 0
) -> str:
    papers, index = readers.read_papers(spark, layout.papers), _label_index(spark, layout)
    size = index.filter(F.col("cate") == cate).count()
    sampled = amount is not None and amount < size
    name = spark.range(1).select(export.label_export_name(F.lit(cate), F.lit(size), amount, str(seed))).first()[0]
    rows = (
        export.random_of_label(papers, index, cate, amount, seed) if sampled else export.of_label(papers, index, cate)
    )
    return _export(rows, layout, name)


def label_counts(spark: SparkSession, layout: Layout, registry: Registry = None) -> DataFrame:
    """Papers per label, largest first, with the grand total and the number of labels on each row."""
    labels = reg.second_level(registry or reg.default_registry())
    per_label = counts.label_counts(_label_index(spark, layout), labels)
    # One row per registry entry: a window over all of them is small.
    every = Window.partitionBy()
    return (
        per_label.withColumns({"total": F.sum("count").over(every), "labels": F.count("*").over(every)})
        .orderBy(F.desc("count"), "ord")
        .drop("ord")
    )


# --- variants and masks -------------------------------------------------------------------------------


def make_variants(spark: SparkSession, layout: Layout, seeds_path: str, source_path: str, compression: str = writers.PLAIN) -> str:
    source = spark.range(1).select(source_label(F.lit(source_path.rstrip("/")))).first()[0]
    seeds, sources = readers.read_seeds(spark, seeds_path), readers.read_records(spark, source_path)
    path = layout.export("variant")
    folders = seeds.select("id").distinct().count() * (len(variant.TEXT_FEATURES) + len(variant.SWEEPS))
    writers.write_variants(variant.all_variants(seeds, sources, source), path, folders, compression)
    return path


def make_masks(spark: SparkSession, layout: Layout, source_path: str, compression: str = writers.PLAIN) -> str:
    """Mask exported or completed papers."""
    path = layout.export("masking")
    papers = readers.read_records(spark, source_path, schemas.MASK_INPUT)
    writers.write_masked(mask.mask_features(papers), path, compression)
    return path
