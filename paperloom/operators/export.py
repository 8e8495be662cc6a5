"""Exports of the corpus: by id range, id list, label, or at random."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from paperloom.functions.text import crc_token
from paperloom.operators.sample import sample
from paperloom.schemas import PAPER_RECORD
from paperloom.session import durable

# Size of a random export if none is asked for; rows per page.
RANDOM_EXPORT = 30_000
PAGE_ROWS = 100_000

# Bytes of distinct ids that may be broadcast at once, and the number of such parts a longer list may be cut into.
BROADCAST_BYTES = 40_000_000
MOST_PARTS = 16


def record_columns(papers: DataFrame) -> DataFrame:
    """The exported fields, in their order."""
    return papers.select(*PAPER_RECORD.fieldNames())


def by_range(papers: DataFrame, start: int, amount: int) -> DataFrame:
    """`amount` papers after the first `start`. Ids are dense, so this is a pushed-down id filter."""
    return papers.filter((F.col("id") > start) & (F.col("id") <= start + amount))


def page_of(position: Column, rows: int = PAGE_ROWS) -> Column:
    """0-based page of a 1-based position."""
    return F.floor((position - 1) / rows)


def by_ids(
    papers: DataFrame, ids: DataFrame, broadcast_bytes: int = BROADCAST_BYTES, most_parts: int = MOST_PARTS
) -> DataFrame:
    """Papers in the list: repeated ids count once, unknown ones vanish.

    The distinct ids are kept and measured first. Up to `broadcast_bytes` of them are broadcast, so that the wide
    papers stay where they are. A longer list of numbers is cut into ranges of about half that size: each range is a
    pushed-down filter on the papers, whose files are sorted by id, and a broadcast of its own ids. Only what is
    longer than `most_parts` parts, or is no number, is joined by a shuffle.
    """
    wanted = durable(ids.select("id").distinct())
    is_number = isinstance(wanted.schema["id"].dataType, IntegralType)
    width = F.lit(8) if is_number else F.octet_length("id")
    size = wanted.agg(F.sum(width.cast("bigint"))).first()[0] or 0
    if size <= broadcast_bytes:
        return papers.join(F.broadcast(wanted), "id", "left_semi")
    parts = -(-2 * size // broadcast_bytes)
    if not is_number or parts > most_parts:
        return papers.join(wanted, "id", "left_semi")
    cuts = wanted.agg(F.percentile_approx("id", [i / parts for i in range(1, parts)])).first()[0]
    found = None
    for low, high in zip([None, *cuts], [*cuts, None], strict=True):
        inside = (F.lit(True) if low is None else F.col("id") > low) & (F.lit(True) if high is None else F.col("id") <= high)
        part = papers.filter(inside).join(F.broadcast(wanted.filter(inside)), "id", "left_semi")
        found = part if found is None else found.unionByName(part)
    return found


def of_label(papers: DataFrame, index: DataFrame, cate: str) -> DataFrame:
    return by_ids(papers, index.filter(F.col("cate") == cate))


def random_papers(papers: DataFrame, seed: int, amount: int = RANDOM_EXPORT) -> DataFrame:
    return sample(papers, "id", amount, seed)


def random_of_label(papers: DataFrame, index: DataFrame, cate: str, amount: int, seed: int) -> DataFrame:
    """`amount` random papers of a label, or all of them. Ids are drawn before the papers are read."""
    return by_ids(papers, sample(index.filter(F.col("cate") == cate), "id", amount, seed))


# The patterns of export names below.
def range_name(start: int, amount: int) -> str:
    return f"completed_s2_{start + 1}_to_{start + amount}.data"


def label_export_name(cate: Column, size: Column, amount: int | None, run_id: str) -> Column:
    """Name of a label export: `all`, or the amount and a token of the run if it was really sampled."""
    everything = F.lit("all")
    if amount is None:
        suffix = everything
    else:
        drawn = F.concat(F.lit(f"rand_{amount}_"), crc_token(F.lit(run_id)))
        suffix = F.when(F.lit(amount) < size, drawn).otherwise(everything)
    return F.concat(F.lit("completed_s2_arxiv_"), cate, F.lit("_"), suffix, F.lit("_.data"))
