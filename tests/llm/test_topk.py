import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperloom.llm import topk

SCHEMA = "vec_id long,embedding array<float>,label int,q long,v string"


def _brute(rows, k):
    usable = [(i, [math.floor(64 * np.float32(x).item()) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out, done = [], set()
    for qi, q in usable:
        if qi % 20 or qi in done:
            continue
        done.add(qi)
        best = sorted((-sum(a * b for a, b in zip(q, c, strict=False)), ci) for ci, c in usable if ci != qi)[:k]
        out += [(qi, n + 1, ci, -s) for n, (s, ci) in enumerate(best)]
    return sorted(out)


def _search(spark, rows, k=5, **blocks):
    table = spark.createDataFrame([(i, v, 0, 9, "z") for i, v in rows], SCHEMA)
    vectors = topk.quantise(table)
    return sorted(map(tuple, topk.top_k(vectors.where(F.col("vec_id") % 20 == 0), vectors, k, **blocks).collect()))


@pytest.mark.parametrize("density", [0.03, 0.3, 1.0])
def test_equals_brute_force(spark, density):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(0, 0.1, 16) * (rng.random(16) < density)]) for i in range(130)]
    assert _search(spark, rows, query_block=3, candidate_block=20) == _brute(rows, 5)


def test_ties_nulls_and_short_tables(spark):
    same = [0.5, -0.25, 0.125]
    rows = [(i, same) for i in range(45)]
    rows += [(100, None), (120, [1.0, None, 0.0]), (140, [1.0, math.nan, 0.0]), (160, [math.inf, 0.0, 0.0]), (None, same), (180, [1.0]), (200, []), (7, same)]
    assert _search(spark, rows, candidate_block=8) == _brute(rows, 5)
    assert _search(spark, rows[:3], k=20) == _brute(rows[:3], 20)
    assert _search(spark, []) == []
    assert _search(spark, [(20, same)]) == []


def test_large_components_keep_64_bits(spark):
    rows = [(0, [1e6, 2e6]), (1, [3e6, -1e6]), (2, [5e6, 4e6])]
    assert _search(spark, rows) == _brute(rows, 5)


def test_blocks_are_few_for_large_tables_and_enough_for_small_ones():
    assert topk.blocks(0, 0, 8192, 32_768) == (1, 1)
    assert topk.blocks(100, 2_000, 8192, 32_768) == (1, 1)
    assert topk.blocks(2_564, 51_282, 8192, 32_768) == (1, 26)
    q, c = topk.blocks(5_000_000, 100_000_000, 8192, 32_768)
    assert (q, c) == (611, 3052)
