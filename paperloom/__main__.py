"""Command line for spark-submit: `python -m paperloom --base <folder> <command> ...`.

Each command calls one job of `paperloom.plans.commands` and prints what it returns.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from paperloom.operators.export import RANDOM_EXPORT
from paperloom.plans import commands as jobs
from paperloom.session import configure, durable
from paperloom.sources import writers

# Command -> (job, its positional arguments in order). Names and argument order are fixed values.
COMMANDS = {
    "extract-cate": (jobs.extract_category, ("cate",)),
    "extract-topic": (jobs.extract_topic, ("cate", "topic")),
    "topic-count": (jobs.topic_count, ("cate", "topic")),
    "fill-data": (jobs.fill_data, ("name", "partition")),
    "fill-data-stream": (jobs.fill_data_stream, ("name",)),
    "fill-data-status": (jobs.fill_status, ("name", "partition")),
    "merge-data": (jobs.merge_data, ("name",)),
    "clear-partition": (jobs.clear_partition, ("name", "keep")),
    "export-data": (jobs.export_data, ("name",)),
    "init-s2-database": (jobs.init_corpus, ()),
    "extract-s2-cs-data": (jobs.ingest_corpus, ()),
    "s2-cs-data-count": (jobs.corpus_count, ()),
    "export-s2-cs-data": (jobs.export_range, ("first", "amount")),
    "export-s2-cs-data-rand": (jobs.export_random, ()),
    "export-s2-cs-data-from-id": (jobs.export_from_ids, ("ids_path",)),
    "create-s2-index": (jobs.index_topics, ()),
    "count-s2-cs-topic": (jobs.corpus_topic_count, ("topic",)),
    "arxiv-s2-data-match": (jobs.match_label, ("cate",)),
    "arxiv-s2-data-match-all": (jobs.match_labels, ()),
    "arxiv-s2-data-extract": (jobs.export_label, ("cate",)),
    "arxiv-s2-data-extract-rand": (jobs.export_label, ("cate", "amount")),
    "arxiv-s2-data-count": (jobs.label_counts, ()),
    "variant": (jobs.make_variants, ("seeds_path", "source_path")),
    "mask": (jobs.make_masks, ("source_path",)),
}
NUMBERS = {"partition", "keep", "first", "amount"}
SEEDED = {"extract-topic", "export-s2-cs-data-rand", "arxiv-s2-data-extract-rand"}
REPORT_ROWS = 10_000  # of a printed report; all have a row or a row per label


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="paperloom")
    root.add_argument("--base", required=True, help="folder of the tables, on storage all executors reach")
    commands = root.add_subparsers(dest="command", required=True)
    for command, (job, names) in COMMANDS.items():
        sub = commands.add_parser(command, help=(job.__doc__ or "").split("\n")[0])
        for name in names:
            sub.add_argument(name, type=int if name in NUMBERS else str)
        if command in SEEDED:
            sub.add_argument("--seed", type=int, default=0)
        if command == "extract-topic":
            sub.add_argument("--store", action="store_true", help="put the ids into the work-list")
            sub.add_argument("--limit", type=int, help="draw so many ids instead of taking all")
        if command in ("variant", "mask"):
            sub.add_argument("--compression", choices=(writers.PLAIN, writers.COMPRESSED), default=writers.PLAIN, help="of the files")
        if command == "export-s2-cs-data-rand":
            sub.add_argument("--amount", type=int, default=RANDOM_EXPORT, help="papers to draw")
    return root


def run(spark: SparkSession, arguments: list[str] | None = None) -> object:
    options = vars(parser().parse_args(arguments))
    layout, command = jobs.Layout(options.pop("base")), options.pop("command")
    return COMMANDS[command][0](configure(spark), layout, **options)


def main() -> None:
    spark = SparkSession.builder.appName("paperloom").getOrCreate()
    result = run(spark)
    if isinstance(result, DataFrame):
        rows = durable(result)
        n = rows.count()
        if n > REPORT_ROWS:
            raise RuntimeError(f"a report of {n} rows is not printed; read it from the job's result")
        rows.show(n, truncate=False)
    elif result is not None:
        print(result)


if __name__ == "__main__":
    main()
