import collections
import hashlib
import re
import time
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from paperloom.llm import periodic


def brute(words, least=12):
    """Every stretch of equal words q apart, for every q; a period that a smaller one divides out is no smallest period."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            if length >= max(least, 2 * q) and (start, length) not in found:
                found[start, length] = q
    return sorted((start, length, q) for (start, length), q in found.items())


def slow_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = sorted(brute(words), key=lambda r: (r[0], r[2]))
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + length for s, length, q in found)]
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    numbers = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    return (doc_id, len(found), *numbers, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(" ".join(kept).encode()).hexdigest())


@settings(max_examples=1500, deadline=None)
@given(st.one_of(st.text("ab", max_size=60), st.text("abc", max_size=80), st.text("abcdefgh", max_size=60)), st.sampled_from([2, 3, 5, 12]))
def test_equals_brute_force(word, least):
    assert sorted(map(tuple, periodic.runs(list(word), least).tolist())) == brute(word, least)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text("abc", min_size=1, max_size=6), st.integers(1, 6)), max_size=8))
def test_repeated_parts(parts):
    words = [c for part, times in parts for c in part * times]
    assert sorted(map(tuple, periodic.runs(words).tolist())) == brute(words)


def test_fibonacci_and_powers():
    a, b = "a", "ab"
    while len(b) < 400:
        a, b = b, b + a
    for word in (b, "a" * 300, "ab" * 150, "aab" * 90 + "aba" * 60):
        assert sorted(map(tuple, periodic.runs(list(word)).tolist())) == brute(word)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 3), min_size=2, max_size=60))
def test_common_extensions_of_the_suffix_tree(symbols):
    tree = periodic.SuffixTree(symbols)
    n = len(symbols)
    i, j = (x.ravel() for x in np.meshgrid(np.arange(n + 1), np.arange(n + 1)))
    i, j = i[i != j], j[i != j]
    for a, b, got in zip(i, j, tree.common(i, j), strict=True):
        x, y = symbols[a:], symbols[b:]
        expected = next((k for k, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))
        assert got == expected
    order = sorted(range(n + 1), key=lambda k: symbols[k:])
    assert [int(r) for r in tree.rank[order]] == list(range(n + 1))


def test_stretches_hold_all_runs():
    rng = np.random.default_rng(1)
    for _ in range(60):
        words = rng.integers(0, 500, 300).tolist()
        for _ in range(4):
            at, q, times = int(rng.integers(0, 280)), int(rng.integers(1, 9)), int(rng.integers(2, 9))
            words[at:at] = words[at : at + q] * times
        found = brute(words)
        parts = periodic._stretches(np.array(words), 6)
        assert all(any(a <= s and s + n <= b for a, b in parts) for s, n, _ in found)
        assert sorted(map(tuple, periodic.runs(words).tolist())) == found
    assert periodic._stretches(np.arange(1000), 6) == []


def test_long_texts_take_linear_time():
    start = time.perf_counter()
    for words in (["a"] * 100_000, ["a", "b"] * 50_000, [str(i % 30_000) for i in range(100_000)]):
        assert len(periodic.runs(words)) == 1
    assert time.perf_counter() - start < 60


def test_tables(docs_of, edge_rows):
    rng = np.random.default_rng(4)
    rows = [*((i, t) for i, t in edge_rows if i != 4), (4, "word another Third " * 200)]
    rows += [(i, " ".join(f"w{x}" for x in rng.integers(0, 3 + i % 40, rng.integers(0, 120)))) for i in range(100, 250)]
    got = periodic.scan_documents(docs_of(rows))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter(slow_row(i, t) for i, t in rows)
    assert sum(r.n_runs > 0 for r in got.collect()) > 8
    assert periodic.scan_documents(docs_of([])).collect() == []


def test_find_and_collapse(docs_of):
    rows = [(1, "x " + "a b c " * 6 + "y"), (2, "no run  here"), (3, None), (None, "z " * 12)]
    assert sorted(map(tuple, periodic.find_runs(docs_of(rows)).collect()), key=str) == [(1, 1, 18, 3), (None, 0, 12, 1)]
    assert {r.doc_id: r.text for r in periodic.collapse_runs(docs_of(rows)).collect()} == {1: "x a b c y", 2: "no run  here", 3: None, None: "z"}


@pytest.mark.parametrize("size", [5, 40])
def test_planted_period_is_found(size):
    words = [f"{i}" for i in range(size * 3)]
    doc_id = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    changed = periodic.with_period(doc_id, words)
    assert len(changed) == len(words) and list(map(tuple, periodic.runs(changed).tolist())) == brute(changed)
