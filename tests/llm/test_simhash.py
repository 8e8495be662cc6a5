import collections
import itertools
import re

import numpy as np
import pytest
import xxhash

from paperloom.llm import components, simhash


def slow_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute(rows):
    prints = [slow_fingerprint(text) for _, text in rows]
    root = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 4:
            a, b = root[i], root[j]
            root = [a if r == b else r for r in root]
    least = {}
    for r, (doc_id, _) in zip(root, rows, strict=True):
        if doc_id is not None:
            least[r] = min(doc_id, least.get(r, doc_id))
    return collections.Counter((doc_id, f"{p:016x}", least.get(r)) for (doc_id, _), p, r in zip(rows, prints, root, strict=True))


def _copies():
    rng = np.random.default_rng(3)
    rows = []
    for i in range(60):
        words = [f"W{x}" for x in rng.integers(0, 400, rng.integers(1, 250))]
        for j in range(rng.integers(1, 5)):
            copy = list(words)
            for at in rng.integers(0, len(copy), min(j, len(copy) // 20)):
                copy[at] = "changed"
            rows.append((int(i * 10 + j), " ".join(copy)))
    return rows


def test_equals_brute_force(docs_of, edge_rows):
    rows = [*_copies(), *((None if i is None else i + 5000, t) for i, t in edge_rows if t is None or len(t) < 1000)]
    got = collections.Counter(map(tuple, simhash.scan_documents(docs_of(rows)).collect()))
    assert got == brute(rows)
    assert len({c for _, _, c in got}) < len(got)
    assert simhash.scan_documents(docs_of([])).collect() == []


@pytest.mark.parametrize("plan", [None, "unequal", "wide"])
@pytest.mark.parametrize("bucket_rows", [1024, 7])
def test_links_connect_all_close_fingerprints(spark, plan, bucket_rows):
    """Random flips around few centres: every partition, threshold and block must keep the graph connected alike."""
    rng = np.random.default_rng(5)
    centres = rng.integers(-(2**63), 2**63, 12)
    prints = {int(c) for c in centres}
    for c in centres:
        for _ in range(25):
            flips = rng.choice(64, rng.integers(1, 7), replace=False)
            prints.add(int(np.bitwise_xor.reduce(np.append(np.uint64(1) << flips.astype(np.uint64), np.int64(c).view(np.uint64))).view(np.int64)))
    prints = sorted(prints)
    distinct = spark.createDataFrame([(p,) for p in prints], "fp long")
    bits = list(range(64))
    plans = {
        None: simhash.plan_search(distinct),
        "unequal": [(bits[:16], 0), (bits[16:32], 1), (bits[32:48], 1), (bits[48:], -1)],
        "wide": [(bits[::2], 2), (bits[1::2], 1)],
    }
    chosen = [(b, t) for b, t in plans[plan] if t >= 0]
    assert sum(t + 1 for _, t in chosen) == simhash.ALLOWED + 1
    links = [(r.a, r.b) for r in simhash.links(distinct, chosen, bucket_rows=bucket_rows).collect()]
    assert all(True for _ in links)

    def classes(pairs):
        root = {p: p for p in prints}
        for a, b in pairs:
            a, b = root[a], root[b]
            if a != b:
                root = {p: min(a, b) if r in (a, b) else r for p, r in root.items()}
        return root

    close = [(a, b) for a, b in itertools.combinations(prints, 2) if ((a ^ b) & (2**64 - 1)).bit_count() <= 4]
    assert classes(links) == classes(close)


def test_allocation_is_the_best_one():
    rng = np.random.default_rng(2)
    for _ in range(50):
        m = int(rng.integers(2, 6))
        costs = [[0.0, *np.cumsum(rng.random(3)).tolist()] for _ in range(m)]
        options = [c for c in itertools.product(range(4), repeat=m) if sum(c) == 5]
        cost, thresholds = simhash.allocate(costs, 5)
        assert sum(t + 1 for t in thresholds) == 5
        assert cost == pytest.approx(min(sum(costs[i][t] for i, t in enumerate(c)) for c in options))


def test_bit_groups_put_correlated_bits_together():
    correlation = np.eye(8)
    for a, b in ((0, 5), (1, 6), (2, 7), (3, 4)):
        correlation[a, b] = correlation[b, a] = 0.9
    groups = simhash.group_bits(correlation, 4)
    assert sorted(map(tuple, groups)) == [(0, 5), (1, 6), (2, 7), (3, 4)]


def test_components(spark):
    rng = np.random.default_rng(8)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(1000 + i, 1001 + i) for i in range(40)] + [(7, 7), (2000, 2100)] * 2
    frame = spark.createDataFrame(pairs, "a long,b long")
    got = {r.node: r.root for r in components.connected(frame).collect()}
    root = {}
    for a, b in pairs:
        ra, rb = root.setdefault(a, a), root.setdefault(b, b)
        root = {k: min(ra, rb) if v in (ra, rb) else v for k, v in root.items()}
    for node, expected in root.items():
        assert got.get(node, node) == expected
    assert components.connected(frame.limit(0)).collect() == []


def test_one_of_each(docs_of, edge_rows):
    """One row per component: its smallest id, also where rows without id or with a shared id are in it."""
    rows = [*_copies(), *((None if i is None else i + 5000, t) for i, t in edge_rows if t is None or len(t) < 1000)]
    rows += [(9000, rows[0][1]), (9000, rows[0][1] + " x"), (9001, "a wholly different pair of texts under one id"), (9001, "nothing like the other one at all, is it")]
    rows += [(9002, "a wholly different pair of texts under one id"), (9003, "nothing like the other one at all, is it"), (None, "no id at all")]
    docs = docs_of(rows)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    prints = {t: slow_fingerprint(t) for _, t in rows}
    groups = []
    for p in set(prints.values()):
        near = [g for g in groups if any((p ^ q).bit_count() <= 4 for q in g)]
        groups = [g for g in groups if g not in near] + [{p}.union(*near)]
    expected = collections.Counter()
    for g in groups:
        member = [(i is None, i or 0, simhash._signed(prints[t])) for i, t in rows if prints[t] in g]
        nameless, i, p = min(member)
        expected[None if nameless else i, p] += 1
    assert collections.Counter((r.doc_id, simhash._signed(slow_fingerprint(r.text))) for r in kept.collect()) == expected
    assert simhash.one_of_each(docs_of([])).collect() == []


def test_one_of_each_keeps_clashing_columns(spark):
    """Columns under the names that the operator works with are passed on as they are."""
    schema = "doc_id long, text string, row string, fp long, kept_id int, kept_fp int, shared_id int, n int, root int, __key int"
    rows = [(1, "one text of its own", "r", 5, 6, 7, 8, 9, 10, 11), (2, "one text of its own", "s", 1, 2, 3, 4, 5, 6, 7), (3, None, "t", *[None] * 7), (3, None, "t", *[None] * 7)]
    docs = spark.createDataFrame(rows, schema)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect())) == [rows[0], rows[2]]
