import random

from hypothesis import given, settings
from hypothesis import strategies as st

from paperloom.llm import decontaminate as d

ITEMS = "item_id long,text string"


def _distances(pattern, words):
    row = [0] * (len(words) + 1)
    for i, a in enumerate(pattern, 1):
        new = [i]
        for j, b in enumerate(words, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return row[1:]


WORDS = st.lists(st.sampled_from("abcd"), min_size=1, max_size=45)


@settings(max_examples=200, deadline=None)
@given(WORDS, WORDS)
def test_bit_parallel_distance(pattern, words):
    masks = {}
    for i, w in enumerate(pattern):
        masks[w] = masks.get(w, 0) | 1 << i
    assert [s for s, _ in d.distance_ends(masks, len(pattern), words)] == _distances(pattern, words)


def test_finds_exactly_what_brute_force_finds():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(5, 60)))) for i in range(25)]
    matcher = d.Matcher(items)
    for _ in range(150):
        words = rng.choices(vocabulary, k=rng.randint(0, 60))
        for _, text in rng.sample(items, 2):
            copy = text.split()
            for _ in range(rng.randint(0, 8)):
                at = rng.randrange(len(copy) + 1)
                copy[at : at + rng.randint(0, 1)] = rng.choices(vocabulary, k=rng.randint(0, 1))
            place = rng.randint(0, len(words))
            words[place:place] = copy
        expected = {}
        for i, item in items:
            pattern = item.split()
            parts = [pattern[low : low + 32] for low in (*range(0, len(pattern) - 32, 16), len(pattern) - 32)] if len(pattern) > 32 else []
            for own, whole in ((pattern, True), *((part, False) for part in parts)):
                least = min(_distances(own, words), default=99)
                if least <= len(own) // 5:
                    expected[i] = min((not whole, least), expected.get(i, (True, 99)))
        assert {m[0]: (not m[4], m[1]) for m in matcher.matches(" ".join(words))} == expected


def test_place_of_a_match():
    item = "one two three four five six seven eight nine ten"
    assert d.Matcher([(3, item)]).matches("x y. One, two three four FIVE six seven eight nine ten! z") == [(3, 0, 2, 11, True)]
    assert d.Matcher([(3, item)]).matches("One two three zero five six seven eight nine ten") == [(3, 1, 0, 9, True)]
    assert d.Matcher([(3, item)]).matches("One two three and five or seven eight but ten") == []


def test_an_item_is_matched_as_a_whole_at_every_length():
    """The same share of edits is found at 32, 33 and 200 words, and an item under five words as it stands."""
    for n in (1, 4, 5, 31, 32, 33, 59, 200):
        words = [f"w{i}" for i in range(n)]
        matcher = d.Matcher([(1, " ".join(words))])
        changed = list(words)
        for i in range(n // 5):
            changed[i * 5] = "x"
        assert matcher.matches("a b " + " ".join(changed) + " c") == [(1, n // 5, 2, n + 1, True)]
        changed[next(i for i in range(n // 2, n) if changed[i] == words[i])] = "y"  # one edit more
        assert not any(m[4] for m in matcher.matches(" ".join(changed)))
    assert d.Matcher([(1, "one two")], least_words=3).matches("one two three") == []


def test_a_quotation_from_a_longer_item():
    words = [f"w{i}" for i in range(100)]
    matcher = d.Matcher([(1, " ".join(words))])
    for low in range(0, 53):
        found = matcher.matches("a " + " ".join(words[low : low + 47]) + " b")
        assert found and not found[0][4]


def test_tables(spark, docs_of, edge_rows):
    item = "alpha beta gamma delta epsilon zeta eta theta"
    benchmark = spark.createDataFrame([(1, item), (1, item), (2, None), (None, item), (3, ""), (4, "nowhere to be found"), (5, "no id at all now")], ITEMS)
    rows = [*edge_rows, (20, f"before {item} after"), (20, f"before {item} after"), (21, "alpha beta gamma")]
    docs = docs_of(rows)
    got = sorted(map(tuple, d.leaks(docs, benchmark).where("doc_id is not null").collect()))
    assert got == [(20, 1, 0, 1, 8, True)] * 2
    assert [r.item_id for r in d.leaks(docs, benchmark).where("doc_id is null").collect()] == [5]
    kept = d.without_leaks(docs, benchmark)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 3
    assert d.leaks(docs_of([]), benchmark).collect() == []
    assert d.leaks(docs, benchmark.limit(0)).collect() == []
    assert d.without_leaks(docs, benchmark.limit(0)).count() == len(rows)


def test_a_benchmark_in_parts_gives_the_same(spark, docs_of, monkeypatch):
    rng = random.Random(9)
    items = [(i, " ".join(f"t{rng.randrange(99)}" for _ in range(12))) for i in range(30)]
    docs = docs_of([(i, f"x {text} y") for i, text in items] + [(99, "nothing to see")])
    benchmark = spark.createDataFrame(items, ITEMS)
    whole = sorted(map(tuple, d.leaks(docs, benchmark).collect()))
    monkeypatch.setattr(d, "MAX_BYTES", 600)
    assert sorted(map(tuple, d.leaks(docs, benchmark).collect())) == whole and len(whole) == 30
    assert d.without_leaks(docs, benchmark).count() == 1
