import collections
import hashlib
import time

import numpy as np
import pytest

from paperloom.llm import substring
from paperloom.llm.fm_index import FMIndex, repeated_windows


def brute(rows, window=35):
    words = [(text or "").encode().split() for _, text in rows]
    seen = collections.Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = collections.Counter()
    for (doc_id, _), w in zip(rows, words, strict=True):
        keep = [True] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                keep[i : i + window] = [False] * window
        kept = [x for x, k in zip(w, keep, strict=True) if k]
        out[doc_id, len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()] += 1
    return out


def _rows():
    rng = np.random.default_rng(6)

    def fresh(n):
        return [f"w{x}" for x in rng.integers(0, 3000, n)]

    passage, rows = fresh(60), []
    for i in range(120):
        words = fresh(int(rng.integers(0, 200)))
        if i % 3 == 0:
            low = int(rng.integers(0, 20))
            words[10:10] = passage[low : low + int(rng.integers(30, 60))]
        if i % 10 == 0:
            words += words[: int(rng.integers(20, 60))]
        if i % 17 == 0:
            words += ["again"] * int(rng.integers(30, 120))
        if i % 13 == 0:
            words += ["one", "two", "three"] * int(rng.integers(8, 40))
        rows.append((i, " ".join(words)))
        if i % 5 == 0:
            copy = list(words)
            if copy:
                copy[len(copy) // 2] = "changed"
            rows.append((1000 + i, "\n".join(copy)))
    return rows


@pytest.mark.parametrize("hot", [substring.HOT_RUNS, 3])
def test_equals_brute_force(docs_of, edge_rows, monkeypatch, hot):
    monkeypatch.setattr(substring, "HOT_RUNS", hot)
    rows = [*_rows(), *edge_rows, (None, " ".join(f"n{i}" for i in range(50))), (None, " ".join(f"n{i}" for i in range(50)))]
    got = collections.Counter(map(tuple, substring.scan_documents(docs_of(rows)).collect()))
    expected = brute(rows)
    assert got == expected
    assert sum(n > 0 for (_, _, n, _) in expected) > 40


@pytest.mark.parametrize("doc_id", [None, 7])
def test_many_rows_of_one_identity(docs_of, doc_id):
    """Rows of one text without id, or with one id, cost what copies under different ids cost."""
    text = " ".join(f"n{i}" for i in range(400))
    rows = [(doc_id, text)] * 2000 + [(i + 100, text if i % 2 else f"{i} alone") for i in range(20)]
    start = time.perf_counter()
    got = collections.Counter(map(tuple, substring.scan_documents(docs_of(rows)).collect()))
    assert got == brute(rows)
    assert time.perf_counter() - start < 60


def test_kept_words(docs_of):
    words = [f"w{i}" for i in range(40)]
    rows = [(1, " ".join(["head", *words, "tail"])), (2, " ".join(words))]
    got = {r.doc_id: r.kept for r in substring.without_repeats(docs_of(rows)).collect()}
    assert got == {1: "head tail", 2: ""}
    assert substring.without_repeats(docs_of([])).collect() == []


@pytest.mark.parametrize("symbols", [2, 3, 9, 200])
def test_index_counts_windows_by_weight(symbols):
    rng = np.random.default_rng(symbols)
    for window in (5, 35):
        pieces = [rng.integers(1, symbols, rng.integers(1, 62)) for _ in range(60)]
        for _ in range(60):
            a, b = rng.integers(0, 60, 2)
            k = int(rng.integers(1, min(len(pieces[a]), len(pieces[b])) + 1))
            pieces[b] = np.concatenate([pieces[a][:k], pieces[b][k:]])
        weights = np.where(rng.random(60) < 0.1, 2, 1)
        seen = collections.Counter()
        for piece, weight in zip(pieces, weights, strict=True):
            for i in range(len(piece) - window + 1):
                seen[tuple(piece[i : i + window])] += int(weight)
        text = np.concatenate([np.append(p, 0) for p in pieces])
        lengths = np.array([len(p) for p in pieces])
        starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
        masks = repeated_windows(FMIndex(text, symbols, np.repeat(weights, lengths + 1)), text, starts, lengths, window)
        for piece, mask in zip(pieces, masks, strict=True):
            assert mask == sum(1 << i for i in range(len(piece) - window + 1) if seen[tuple(piece[i : i + window])] >= 2)


def test_runs_cover_each_window_once_and_equal_windows_share_an_anchor():
    rng = np.random.default_rng(1)
    words = [b"x%d" % x for x in rng.integers(0, 3, 500)]
    words[200:300] = words[50:150]
    places, anchors, _ = substring.runs_of(words, substring._WordHashes())
    of_window = {}
    for place, anchor in zip(places.tolist(), anchors.tolist(), strict=True):
        start, count = place >> substring.PLACE_BITS, (place & (1 << substring.COUNT_BITS) - 1) + 1
        for i in range(start, start + count):
            assert i not in of_window
            of_window[i] = anchor
    assert sorted(of_window) == list(range(len(words) - substring.WINDOW + 1))
    assert all(of_window[i] == of_window[i + 150] for i in range(50, 50 + 100 - substring.WINDOW + 1))
