"""Feature masking: each paper once per mask, as JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.text import record_json

# Masks in output order, and the value that hides each feature. `full` hides nothing.
MASKS = ("title", "abstract", "venue", "authors", "year", "n_citations", "full")
BLANK = " "


def mask_value(feature: str) -> Column:
    if feature == "authors":
        return F.array().cast("array<string>")
    return F.lit(0) if feature == "n_citations" else F.lit(BLANK)


def mask_features(papers: DataFrame) -> DataFrame:
    """Columns `masking` and `value`.

    The id is left out. NULLs are dropped after masking, so a masked NULL feature shows its mask value. A masked
    year is text, not a number, so the record is JSON and not a typed row. The mask names are exploded
    first and the one JSON text each row needs is built afterwards: a long abstract is copied, not encoded
    seven times in one row.
    """
    kept = [c for c in papers.columns if c != "id"]

    def record(mask: str) -> Column:
        return record_json(*[mask_value(c).alias(c) if c == mask else F.col(f"`{c}`") for c in kept])

    exploded = papers.select("*", F.explode(F.array(*[F.lit(m) for m in MASKS])).alias("masking"))
    text = F.when(F.col("masking") == MASKS[0], record(MASKS[0]))
    for mask in MASKS[1:]:
        text = text.when(F.col("masking") == mask, record(mask))
    return exploded.select("masking", text.alias("value"))
