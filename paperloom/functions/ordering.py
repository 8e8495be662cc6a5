"""Seeded pseudo-random order: the only source of randomness in the package.

`md5(seed || ':' || id)` is reproducible in any engine and spreads any set of distinct ids evenly, so a
prefix of it is a balanced bucket whose order agrees with the order of the whole hash.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PREFIX_DIGITS = 4  # 16**4 buckets at most


def order_hash(key: Column, seed: int | str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"))


def bucket(hash_column: Column, digits: int = PREFIX_DIGITS) -> Column:
    return F.substring(hash_column, 1, digits)
