"""Matching two corpora on the normalised title."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.text import audit_title, title_key
from paperloom.operators.extract import label_papers
from paperloom.registry import Category, label_table

# A key with more rows than this is spread over several tasks.
HOT_ROWS = 1_000_000

# An index whose text is measured to be at most this long is broadcast instead.
BROADCAST_BYTES = 128 * 1024 * 1024

# Bits of the key filter per key of a long index, and its size: at most 64 MB are sent to every task. Beyond it, more
# corpus rows pass than need to; none is lost.
FILTER_BITS_PER_KEY = 8
LEAST_FILTER_BITS, MOST_FILTER_BITS = 1 << 15, 1 << 29


def title_index(
    snapshot: DataFrame, registry: list[Category], ord: Column | None = None, drop_empty_key: bool = False
) -> DataFrame:
    """Last snapshot paper per label and title key, by `ord` (default: the id), then by id and content.

    The order is total and puts a NULL `ord` first, so the choice never depends on the order of rows. `max_by` folds repeated keys on the map side, so a title that fills a third of the snapshot does not
    reach one task.
    """
    keyed = label_papers(
        snapshot.filter(F.col("title").isNotNull()).select(
            "id",
            "title",
            "categories",
            title_key(F.col("title")).alias("title_key"),
            (F.col("id") if ord is None else ord).alias("_ord"),
        ),
        registry,
    )
    if drop_empty_key:
        keyed = keyed.filter("title_key <> ''")
    return (
        keyed.groupBy("cate", "title_key")
        .agg(F.max_by(F.struct("id", "title", "categories"), F.struct("_ord", "id", "title", "categories")).alias("paper"))
        .select(
            "cate",
            "title_key",
            F.col("paper.id").alias("arxiv_id"),
            F.col("paper.title").alias("a_title"),
            "paper.categories",
        )
    )


def with_title_key(papers: DataFrame) -> DataFrame:
    """Corpus rows with their key; the ingested table already stores it."""
    if "title_key" in papers.columns:
        return papers
    # Coalesced to be non-nullable: a join would otherwise add a filter that computes the key a second time.
    key = F.coalesce(title_key(F.col("title")), F.lit(""))
    return papers.filter(F.col("title").isNotNull()).withColumn("title_key", key)


def match_titles(
    index: DataFrame, papers: DataFrame, hot_rows: int = HOT_ROWS, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Every corpus paper whose key is in the index, once per label.

    `index` is read several times, so pass a checkpointed one. Its text is measured first: a short index is broadcast,
    which leaves the corpus where it is. A long one is joined by a shuffle that spreads hot keys; before it, corpus rows
    whose key can't be in the index are left out by a filter of the keys' hashes.
    """
    corpus = with_title_key(papers).select("id", F.col("title").alias("s_title"), "title_key")
    text_bytes = sum((F.octet_length(F.coalesce(c, F.lit(""))) for c in index.columns), F.lit(0))
    measured, keys = index.agg(F.sum(text_bytes.cast("bigint")), F.count("*")).first()
    if (measured or 0) <= broadcast_bytes:
        matched = corpus.join(F.broadcast(index), "title_key")
    else:
        matched = _spread_join(may_match(corpus, index, keys), index, hot_rows)
    return matched.select("cate", "id", "arxiv_id", "categories", "a_title", "s_title")


def _filter_place(bits: int) -> tuple[Column, Column]:
    """The bitmap of a key's bit and the bit's place in it."""
    bit = F.pmod(F.xxhash64("title_key"), F.lit(bits))
    size = 8 * 4096  # fixed value: bits of what bitmap_construct_agg makes
    return F.floor(bit / size).cast("int").alias("_bitmap"), (bit % size).cast("int").alias("_bit")


def key_filter(index: DataFrame, keys: int) -> tuple[DataFrame, int]:
    """A bitmap of the hashes of the index's keys, one row per 32,768 bits, and its number of bits."""
    bits = min(MOST_FILTER_BITS, max(LEAST_FILTER_BITS, 1 << (FILTER_BITS_PER_KEY * max(1, keys) - 1).bit_length()))
    places = index.select(*_filter_place(bits))
    return places.groupBy("_bitmap").agg(F.expr("bitmap_construct_agg(_bit)").alias("_bits")), bits


def may_match(corpus: DataFrame, index: DataFrame, keys: int) -> DataFrame:
    """The corpus rows whose key may be in the index: all that are, and of the others about one in eight."""
    bitmaps, bits = key_filter(index, keys)
    octet = F.conv(F.hex(F.substring("_bits", F.floor(F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.floor(octet / F.pow(F.lit(2), F.col("_bit") % 8)) % 2 == 1
    # Bounded broadcast: MOST_FILTER_BITS / 8 bytes.
    return corpus.select("*", *_filter_place(bits)).join(F.broadcast(bitmaps), "_bitmap").filter(is_set).select(*corpus.columns)


def _spread_join(corpus: DataFrame, index: DataFrame, hot_rows: int) -> DataFrame:
    """Shuffled join in which no task gets more than about `hot_rows` corpus rows of one key.

    Corpus keys are counted first (hash and count only, combined on the map side). A key above `hot_rows` is
    cut into shares by paper id, and the index rows of that key are repeated per share. All rows stay.
    """
    key_hash = F.xxhash64("title_key").alias("_key_hash")
    hot = (
        corpus.groupBy(key_hash)
        .agg(F.count("*").alias("_rows"))
        .filter(F.col("_rows") > hot_rows)
        .select("_key_hash", F.ceil(F.col("_rows") / hot_rows).cast("int").alias("_shares"))
    )
    # Bounded broadcast: at most (corpus rows / hot_rows) keys can pass the filter.
    hot = F.broadcast(hot)
    shares = F.coalesce(F.col("_shares"), F.lit(1))
    # First join key: one number per key and share, so that sorting rarely compares titles.
    slot = F.xxhash64("_key_hash", "_share").alias("_slot")
    left = (
        corpus.select("*", key_hash)
        .join(hot, "_key_hash", "left")
        .withColumn("_share", F.pmod(F.xxhash64("id"), shares).cast("int"))
        .select(slot, *corpus.columns)
    )
    right = (
        index.select("*", key_hash)
        .join(hot, "_key_hash", "left")
        .withColumn("_share", F.explode(F.sequence(F.lit(0), shares - 1)))
        .select(slot, *index.columns)
    )
    return left.join(right, ["_slot", "title_key"])


def label_index(matches: DataFrame) -> DataFrame:
    return matches.select("id", "cate")


def match_audit(matches: DataFrame) -> DataFrame:
    """Both titles of each match on one line, for reading."""
    return matches.select(
        "cate",
        "id",
        "categories",
        audit_title(F.col("a_title"), squeeze=True).alias("a_title"),
        audit_title(F.col("s_title"), squeeze=False).alias("s_title"),
    )


def match_rate(index: DataFrame, matches: DataFrame, registry: list[Category]) -> DataFrame:
    """Matches per 100 keys for every label of the registry; NULL for a label without keys.

    Several corpus papers may share a key, so a rate can exceed 100.
    """
    keys = index.groupBy("cate").agg(F.count("*").alias("n_keys"))
    found = matches.groupBy("cate").agg(F.count("*").alias("n_matches"))
    labels = label_table(index.sparkSession, registry).select("cate")
    joined = labels.join(keys, "cate", "left").join(found, "cate", "left")
    joined = joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_keys", "n_matches")})
    return joined.withColumn("rate", rate(F.col("n_matches"), F.col("n_keys")))


def rate(matches: Column, keys: Column) -> Column:
    """Percentage with two decimals; NULL without keys."""
    return F.round(F.lit(100.0) * matches / F.nullif(keys, F.lit(0)), 2)
