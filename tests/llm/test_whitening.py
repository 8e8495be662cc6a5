import math

import numpy as np
import pytest

from paperloom.llm import whitening


def _same_pairs(matrix, values, vectors):
    expected = np.linalg.eigvalsh(matrix)[::-1][: len(values)]
    scale = max(1e-300, np.abs(np.linalg.eigvalsh(matrix)).max())
    assert np.abs(values - expected).max() <= 1e-12 * scale
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() <= 1e-12
    assert np.abs(matrix @ vectors - vectors * values).max() <= 1e-11 * scale


@pytest.mark.parametrize("n", [1, 2, 3, 9, 40])
def test_counts_of_negative_pivots(n):
    rng = np.random.default_rng(n)
    for _ in range(20):
        a = rng.standard_normal((n, n))
        a = a + a.T
        if rng.random() < 0.5:
            a *= rng.random((n, n)) < 0.3
            a = a + a.T
        values = np.linalg.eigvalsh(a)
        for shift in (*rng.uniform(-3, 3, 5), *((values[1:] + values[:-1]) / 2)):
            if np.abs(values - shift).min() > 1e-9:
                assert whitening.below(a, shift) == (values < shift).sum()


def test_pivots_of_two():
    assert whitening.below(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1
    assert whitening.below(np.zeros((3, 3)), 1.0) == 3 and whitening.below(np.zeros((3, 3)), -1.0) == 0


@pytest.mark.parametrize("kind", ["random", "flat", "repeated", "close", "steep", "low rank", "identity", "tiny"])
def test_leading_pairs(kind):
    rng = np.random.default_rng(7)
    n = 30
    q = np.linalg.qr(rng.standard_normal((n, n)))[0]
    spectrum = {
        "random": rng.random(n) * 100, "flat": 1 + rng.random(n) * 1e-3, "repeated": np.repeat([9.0, 5.0, 2.0], 10),
        "close": np.concatenate([[7, 7 - 1e-9, 7 - 1e-6, 3, 3 + 1e-11], rng.random(n - 5)]), "steep": 10.0 ** -np.arange(n),
        "low rank": np.concatenate([[4, 2, 1], np.zeros(n - 3)]), "identity": np.ones(n), "tiny": rng.random(n) * 1e-30,
    }[kind]
    matrix = np.eye(n) if kind == "identity" else q * spectrum @ q.T
    matrix = (matrix + matrix.T) / 2
    _same_pairs(matrix, *whitening.leading(matrix, 8))


def test_leading_pairs_of_small_matrices():
    assert whitening.leading(np.zeros((3, 3)), 8)[0].tolist() == [0, 0, 0]
    _same_pairs(np.array([[5.0]]), *whitening.leading(np.array([[5.0]]), 8))
    _same_pairs(np.array([[2.0, 1.0], [1.0, 2.0]]), *whitening.leading(np.array([[2.0, 1.0], [1.0, 2.0]]), 8))


def _vectors(spark, rows):
    return spark.createDataFrame([(*row, 1, [1.0], "x") for row in rows], "vec_id long,embedding array<float>,n long,v array<float>,whitened string")


def slow(rows, count=8):
    """The definition in exact integers and numpy's own eigenvectors."""
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in kept], dtype=object)
    n, sums = len(kept), x.sum(0)
    deviation = [int(sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True))) for row in x]
    centred = np.array([[float(n * a - s) / n for a, s in zip(row, sums, strict=True)] for row in x])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:count], vectors[:, ::-1][:, :count]
    return kept, deviation, centred @ vectors / np.sqrt(values), values / np.trace(centred.T @ centred / n)


def test_query_equals_definition(spark):
    rng = np.random.default_rng(11)
    base = rng.standard_normal((300, 12)) * np.linspace(3, 0.2, 12)
    rows = [(int(i) if i % 50 else None, [float(np.float32(c)) for c in v]) for i, v in enumerate(base)]
    rows += [rows[5], (900, None), (901, []), (902, [None] + [1.0] * 11), (903, [math.nan] * 12), (904, [math.inf] * 12)]
    kept, deviation, white, explained = slow(rows)
    got = whitening.scan_vectors(_vectors(spark, [*rows, (905, [1.0, 2.0])])).collect()
    assert len(got) == 8 * len(kept) and {r.n for r in got} == {len(kept)}
    error = {r.identity_error for r in got}
    assert len(error) == 1 and 0 <= error.pop() < 1e-10
    by_component = [sorted((r for r in got if r.component == k), key=lambda r: (r.vec_id or -1, r.deviation)) for k in range(1, 9)]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] or -1, deviation[i]))
    for k, own in enumerate(by_component):
        assert [(r.vec_id, r.deviation, r.deviation_text) for r in own] == [(kept[i][0], deviation[i], str(deviation[i])) for i in order]
        expected, found = white[order, k], np.array([r.whitened for r in own])
        assert min(np.abs(found - expected).max(), np.abs(found + expected).max()) < 1e-9
        assert own[0].explained == pytest.approx(explained[k], rel=1e-9)


def test_edge_tables(spark):
    assert whitening.scan_vectors(_vectors(spark, [])).collect() == []
    assert whitening.scan_vectors(_vectors(spark, [(1, None), (2, []), (3, [None])])).collect() == []
    one = whitening.scan_vectors(_vectors(spark, [(1, [0.5, 0.25, 1e30])])).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(k, 1, 0, None, 0.0, 0.0) for k in (1, 2, 3)]
    # Two equal columns and a constant one: rank one of three.
    rows = [(i, [float(i), float(i), 3.0]) for i in range(10)]
    got = whitening.scan_vectors(_vectors(spark, rows)).collect()
    assert all((r.whitened is None) == (r.component > 1) for r in got) and all(r.identity_error < 1e-9 for r in got)
    # Equal frequency of two lengths: the longer one is fitted.
    got = whitening.scan_vectors(_vectors(spark, [(1, [1.0]), (2, [1.0, 2.0])])).collect()
    assert {r.vec_id for r in got} == {2}


def test_deviation_beyond_64_bits(spark):
    rows = [(i, [1e9 if i % 2 else -1e9, 0.0]) for i in range(4)]
    got = whitening.scan_vectors(_vectors(spark, rows)).collect()
    x = [math.floor(1024 * float(np.float32(v[0]))) for _, v in rows]
    exact = (4 * x[0] - sum(x)) ** 2
    assert exact >= 2**63 and all(r.deviation is None and r.deviation_text == str(exact) for r in got)


def test_transform(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(5).tolist()) for i in range(80)]
    usable = whitening.usable(_vectors(spark, rows))
    model = whitening.fit(usable, 3)
    out = whitening.transform(usable, model).collect()
    w = np.array([r.whitened for r in out])
    assert w.shape == (80, 3) and np.abs(np.cov(w.T, bias=True) - np.eye(3)).max() < 1e-10
