"""Counterfactual variants: seed papers with one feature taken from elsewhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Features taken from source papers, and the swept numeric ones (name, feature label, values).
TEXT_FEATURES = ("title", "abstract", "venue", "authors")
SWEEPS = {"year": ("year", 2_050), "n_citations": ("citation", 10_000)}

# Seeds up to this number and this many bytes of text travel with the plan; beyond it both sides are fragmented.
INLINE_SEEDS = 64
INLINE_BYTES = 1_000_000


def pair_with_seeds(
    sources: DataFrame, seeds: DataFrame, inline_seeds: int = INLINE_SEEDS, splits: int | None = None,
    inline_bytes: int = INLINE_BYTES,
) -> DataFrame:
    """Every source row with every seed, as columns `seed` and `src`: the output of this feature.

    Few seeds (at most `inline_seeds`, and `inline_bytes` of them, both measured) become one array that each source row
    explodes: no join and no shuffle. More seeds are cut into fragments of about that number and the sources into even
    splits; a source row is repeated once per fragment and meets it through an equi-join on (fragment, split).
    """
    seed, src = F.struct(*[F.col(f"`{c}`") for c in seeds.columns]), F.struct(*TEXT_FEATURES)
    measured = seeds.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(F.to_json(seed)).cast("bigint")), F.lit(0))).first()
    n_seeds = measured[0]
    if n_seeds <= inline_seeds and measured[1] <= inline_bytes:
        every_seed = seeds.agg(F.collect_list(seed)).scalar()
        return sources.select(src.alias("src")).select(F.explode(every_seed).alias("seed"), "src")
    fragments = max(-(-n_seeds // inline_seeds), -(-measured[1] // inline_bytes))
    splits = splits or int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Cuts by content, the id included, are the same should a task run again, and need no copy of the sources.
    own = [F.col(f"`{c}`") for c in sources.columns]
    left = sources.select(src.alias("src"), F.pmod(F.xxhash64(*own), F.lit(splits)).cast("int").alias("split"))
    content = F.xxhash64(F.to_json(seed))
    right = seeds.select(seed.alias("seed"), F.pmod(content, F.lit(fragments)).cast("int").alias("fragment"))
    left = left.withColumn("fragment", F.explode(F.sequence(F.lit(0), F.lit(fragments - 1))))
    right = right.withColumn("split", F.explode(F.sequence(F.lit(0), F.lit(splits - 1))))
    return left.join(right, ["fragment", "split"]).select("seed", "src")


def text_variants(
    seeds: DataFrame, sources: DataFrame, source: str, inline_seeds: int = INLINE_SEEDS
) -> DataFrame:
    """Seeds with title, abstract, venue or authors of every source paper, in one pass over the sources.

    All columns of the seeds are carried over.
    """
    paired = pair_with_seeds(sources, seeds, inline_seeds).withColumn(
        "feature", F.explode(F.array(*[F.lit(f) for f in TEXT_FEATURES]))
    )
    fields = [
        F.when(F.col("feature") == f, F.col(f"src.{f}")).otherwise(F.col(f"seed.{f}")).alias(f)
        if f in TEXT_FEATURES
        else F.col(f"seed.`{f}`").alias(f)
        for f in seeds.columns
    ]
    return paired.select(F.col("seed.id").alias("seed_id"), F.lit(source).alias("source"), "feature", *fields)


def sweep_variants(seeds: DataFrame, field: str, source: str) -> DataFrame:
    """Seeds with every value 0..n-1 of a numeric feature."""
    label, n = SWEEPS[field]
    swept = seeds.withColumn("_value", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    fields = [(F.col("_value") if f == field else F.col(f"`{f}`")).alias(f) for f in seeds.columns]
    return swept.select(F.col("id").alias("seed_id"), F.lit(source).alias("source"), F.lit(label).alias("feature"), *fields)


def all_variants(seeds: DataFrame, sources: DataFrame, source: str) -> DataFrame:
    variants = text_variants(seeds, sources, source)
    for field in SWEEPS:
        variants = variants.unionByName(sweep_variants(seeds, field, source))
    return variants
