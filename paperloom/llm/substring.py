"""Substring dedup with an FM-index per shard (operator 5).

A window of 35 words is repeated if the same words also start anywhere else, in another document or in the same one.
Every word that a repeated window covers is removed.

1. Every document is cut into runs of consecutive windows that share an anchor, the smallest 8-gram hash in the window.
   Equal windows have equal anchors, so windows of runs with different anchors need never be compared. Runs whose
   anchor stands once in the corpus cannot hold a repeated window and go no further.
2. Runs of equal words are folded to one with a weight. What is left is a set of distinct pieces of up to 62 words,
   read from one representative document each and sharded by anchor.
3. Each shard's pieces become a compressed FM-index (packed bit planes of a wavelet matrix). The pieces are streamed
   against it by backward search: matching statistics tell which of their windows occur at least twice by weight.
4. The answers go back to all runs of the same words, and from there to the documents.

An anchor with more than HOT_RUNS occurrences (a passage in a large part of the corpus, each time between other words)
would make a hot shard: its distinct pieces are cut into single windows, equal windows are folded, and each is sharded
by its own hash. No other group is larger than HOT_RUNS pieces, and a task indexes at most about SHARD_WORDS words at
once. Hashes of pieces have 128 bits; within a shard words are compared by 64-bit hashes of their bytes.

Nulls count as a text without words; a text under 35 words keeps all. Repeated rows are occurrences of their own, so all
their windows are repeated, and each gets its result. Rows without an id are told apart by their text. An empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.fm_index import FMIndex, repeated_windows
from paperloom.llm.tables import arrow_schema
from paperloom.session import durable, shared_dir

WINDOW = 35
GRAM = 8  # words of an anchor
RUN = WINDOW - GRAM + 1  # most windows of a run
COUNT_BITS = 5  # windows of a run less one; a place is the start, a bit for an anchor met twice, and this
PLACE_BITS = COUNT_BITS + 1
HOT_RUNS = 512
HEAVY_SHARE = 4096  # an anchor with more than one in so many of all runs is folded before it is shuffled
SHARD_WORDS = 1_000_000
CACHED_WORDS, LONGEST_CACHED = 500_000, 64  # words whose hashes a task remembers, and bytes of such a word
_U = np.uint64


class _WordHashes(dict):
    def __missing__(self, word):
        value = xxhash.xxh64_intdigest(word)
        if len(word) <= LONGEST_CACHED:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = value
        return value


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(32))


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def _span_hashes(hashes: np.ndarray, starts: np.ndarray, stops: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash modulo 2**64 of each stretch of words, from prefix sums."""
    powers = np.cumprod(np.concatenate([[_U(1)], np.full(len(hashes), _U(base))]))
    inverse = _U(pow(base, -1, 1 << 64))
    back = np.cumprod(np.concatenate([[_U(1)], np.full(len(hashes), inverse)]))
    prefix = np.concatenate([[_U(0)], np.cumsum(_mix(hashes) * powers[:-1])])
    return _mix((prefix[stops] - prefix[starts]) * back[starts] + (stops - starts).astype(_U))


def _sliding(least: np.ndarray, choose) -> np.ndarray:
    """Least or greatest value of each RUN consecutive ones, by doubling."""
    n, size = len(least) - RUN + 1, 1
    while size * 2 <= RUN:
        least = choose(least[:-size], least[size:])
        size *= 2
    return choose(least[:n], least[RUN - size : RUN - size + n])


def runs_of(words: list[bytes], cache: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, anchors and piece hashes of a document's runs."""
    n = len(words) - WINDOW + 1
    if n < 1:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    hashes = np.fromiter(map(cache.__getitem__, words), _U, len(words))
    gram, size = hashes, 1
    for factor in (0xD6E8FEB86659FD93, 0xA5A3564E27F88693, 0xC2B2AE3D27D4EB4F):  # 2, 4, 8 words
        gram = gram[:-size] * _U(factor) + gram[size:]
        size *= 2
    gram = _mix(gram)
    least = _sliding(gram, np.minimum)
    # A run may hold equal windows itself if its anchor stands twice in it: then the two places follow each other among
    # the grams that some window has chosen.
    edge = np.zeros(RUN - 1, _U)
    chosen = gram[gram == _sliding(np.concatenate([edge, least, edge]), np.maximum)]
    doubled = chosen[1:][chosen[1:] == chosen[:-1]]
    at = np.arange(n)
    changes = np.concatenate([[True], least[1:] != least[:-1]])
    since = at - np.maximum.accumulate(np.where(changes, at, 0))
    starts = np.flatnonzero(since % RUN == 0)
    counts = np.diff(np.append(starts, n))
    pieces = _span_hashes(hashes, starts, starts + counts + (WINDOW - 1), 0x9FB21C651E98DF25)
    anchors = least[starts]
    twice = np.isin(anchors, doubled) if len(doubled) else np.zeros(len(starts), bool)
    places = (starts << PLACE_BITS) | (twice.astype(np.int64) << COUNT_BITS) | (counts - 1)
    return places, anchors.view(np.int64), pieces.view(np.int64)


def _map(frame: DataFrame, start, schema: str) -> DataFrame:
    """Rows of `schema` made from the values of each row; `start` is called once per task."""

    def run(batches):
        work, kinds = start(), arrow_schema(schema)
        for batch in batches:
            rows = [row for i in range(batch.num_rows) for row in work(*(c[i].as_py() for c in batch.columns))]
            columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(columns, kinds, strict=True)], schema=kinds)

    return frame.mapInArrow(run, schema)


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text, and the identity (a, b) of a row: its id, or without one its text's hash, and a second hash."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).select(
        "doc_id", "text", F.coalesce("doc_id", F.xxhash64("text")).alias("a"), F.hash("text").alias("b")
    )


def _runs(keyed: DataFrame) -> DataFrame:
    """a, b, place, anchor, piece of all runs, written once so that texts are hashed once."""

    def start():
        cache = _WordHashes()
        return lambda a, b, text: [(a, b, *runs_of(_words(text), cache))]

    rows = _map(keyed.select("a", "b", "text"), start, "a long,b int,place array<long>,anchor array<long>,piece array<long>")
    path = f"{shared_dir(keyed.sparkSession)}/runs-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    found = keyed.sparkSession.read.parquet(path)
    return found.selectExpr("a", "b", "inline(arrays_zip(place, anchor, piece))")


def _pieces_of(wanted, text):
    words = _words(text)
    for item in wanted:
        start, count = item["place"] >> PLACE_BITS, (item["place"] & (1 << COUNT_BITS) - 1) + 1
        yield item, words, start, count


def _first_times():
    """Whether an identity is met for the first time in a task. Rows of one identity hold the same text and give the same
    pieces; the join puts them into one task, and where it does not, equal pieces are folded later.
    """
    met = set()

    def new(identity: tuple) -> bool:
        size = len(met)
        met.add(identity)
        return len(met) > size

    return new


def _window_ids(words: list[bytes], start: int, count: int):
    """Bytes and 128-bit hash, as two signed integers, of each of `count` windows."""
    for i in range(count):
        joined = b" ".join(words[start + i : start + i + WINDOW])
        digest = np.frombuffer(xxhash.xxh3_128_digest(joined), np.int64)
        yield i, joined, int(digest[0]), int(digest[1])


def _search(rows: DataFrame) -> DataFrame:
    """(p1, p2, flipped, mask) of the pieces with repeated windows, from rows (p1, p2, weight, words).

    `flipped` names p1 once more, as a column that no shuffle has dealt out: a join by it shuffles both sides, and only
    then the rows of a frequent piece can be split.
    """
    schema = "p1 long,p2 long,flipped long,mask long"

    def shard(p1, p2, weight, texts):
        cache = _WordHashes()
        cut = [t.split(b" ") for t in texts]
        lengths = np.array([len(words) for words in cut], np.int64)
        hashes = np.fromiter((cache[w] for words in cut for w in words), _U, int(lengths.sum()))
        distinct, symbols = np.unique(hashes, return_inverse=True)
        starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
        text = np.zeros(len(hashes) + len(cut), np.int64)
        text[np.arange(len(hashes)) + np.repeat(np.arange(len(cut)), lengths)] = symbols + 1
        index = FMIndex(text, len(distinct) + 1, np.repeat(np.array(weight, np.int64), lengths + 1))
        masks = repeated_windows(index, text, starts, lengths, WINDOW)
        hit = np.flatnonzero(masks)
        p1, p2 = np.array(p1, np.int64)[hit], np.array(p2, np.int64)[hit]
        return pa.RecordBatch.from_pydict({"p1": p1, "p2": p2, "flipped": p1 ^ 1, "mask": masks[hit]})

    def run(batches):
        held, words, last = ([], [], [], []), 0, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:2] == last:
                    continue  # the representative document stands twice in the table
                if words > SHARD_WORDS and row[0] != last[0]:
                    yield shard(*held)
                    held, words = ([], [], [], []), 0
                for column, value in zip(held, row, strict=True):
                    column.append(value)
                words += row[3].count(b" ") + 2
                last = row[:2]
        if words:
            yield shard(*held)

    return rows.repartition("p1").sortWithinPartitions("p1", "p2").mapInArrow(run, schema)


def repeated_runs(keyed: DataFrame) -> DataFrame:
    """(a, b, found): for each document with repeated windows, its runs' places and masks of repeated windows."""
    runs = _runs(keyed)
    often = runs.groupBy("anchor").agg(F.expr(f"sum(1 + ((place >> {COUNT_BITS}) & 1))").alias("n")).where("n > 1")
    often = durable(often)
    total = runs.count()
    # At most 2 * HEAVY_SHARE anchors can be that frequent, so they may be broadcast.
    heavy = F.broadcast(often.where(F.col("n") > max(HOT_RUNS, total // HEAVY_SHARE)))
    columns = ["a", "b", "place", "anchor", "piece", F.expr(f"n > {HOT_RUNS} as hot")]
    light_runs = runs.join(heavy, "anchor", "left_anti").join(often, "anchor").select(*columns)
    heavy_runs = runs.join(heavy, "anchor").select(*columns)

    def folded(rows: DataFrame) -> DataFrame:
        """Pieces of equal words: their weight and one place they stand at."""
        return rows.groupBy("anchor", "piece").agg(
            F.count("*").alias("weight"), F.min(F.struct("a", "b", "place")).alias("at"), F.max("hot").alias("hot")
        )

    # The rows of a light anchor are together after the join and are folded there; those of heavy anchors are not
    # shuffled as they are, but folded in their tasks first.
    distinct = folded(light_runs).unionByName(folded(heavy_runs))
    wanted = distinct.groupBy(F.col("at.a").alias("a"), F.col("at.b").alias("b")).agg(
        F.collect_list(F.struct(F.col("at.place").alias("place"), "anchor", "piece", "weight", "hot")).alias("wanted")
    )
    # With the same columns as in _kept, so that the texts are shuffled once for both.
    sources = keyed.join(wanted, ["a", "b"]).select("wanted", "text", "doc_id", "a", "b")

    def plain():
        new = _first_times()

        def pieces(wanted, text, *identity):
            if not new(identity):
                return
            for item, words, start, count in _pieces_of([w for w in wanted if not w["hot"]], text):
                yield item["anchor"], item["piece"], item["weight"], b" ".join(words[start : start + count + WINDOW - 1])

        return pieces

    def cut():
        new = _first_times()

        def windows(wanted, text, *identity):
            if not new(identity):
                return
            for item, words, start, count in _pieces_of([w for w in wanted if w["hot"]], text):
                for _, joined, p1, p2 in _window_ids(words, start, count):
                    yield p1, p2, item["weight"], joined

        return windows

    def linked():
        new = _first_times()

        def windows(wanted, text, *identity):
            if not new(identity):
                return
            for item, words, start, count in _pieces_of([w for w in wanted if w["hot"]], text):
                for i, _, p1, p2 in _window_ids(words, start, count):
                    yield p1 ^ 1, p2, item["anchor"] ^ 1, item["piece"], 1 << i

        return windows

    schema = "p1 long,p2 long,weight long,words binary"
    hot = sources.where(F.exists("wanted", lambda w: w.hot))
    windows = _map(hot, cut, schema).groupBy("p1", "p2").agg(F.sum("weight").alias("weight"), F.first("words").alias("words"))
    # Read twice below, each time with the same columns: dealt out once, so that the shards are searched once.
    answers = _search(_map(sources, plain, schema).unionByName(windows)).repartition("p1", "p2")
    # Answers to windows go back to the pieces they were cut from; the others are pieces themselves.
    links = _map(hot, linked, "flipped long,p2 long,owner long,piece long,bit long")
    of_windows = links.join(answers.select("flipped", "p2", "mask"), ["flipped", "p2"]).groupBy("owner", "piece").agg(
        F.bit_or(F.when(F.col("mask") != 0, F.col("bit")).otherwise(0)).alias("mask")
    )
    masks = answers.selectExpr("flipped", "p2 as piece", "mask").unionByName(of_windows.withColumnRenamed("owner", "flipped"))
    alive = light_runs.unionByName(heavy_runs).selectExpr("a", "b", "place", "anchor ^ 1L as flipped", "piece")
    return (
        alive.join(masks, ["flipped", "piece"])
        .groupBy("a", "b").agg(F.collect_set(F.struct("place", "mask")).alias("found"))
    )


def keep_mask(n_words: int, found) -> np.ndarray:
    """Which words stay, given the places and masks of repeated windows."""
    change = np.zeros(n_words + 1, np.int64)
    for item in found or ():
        start, mask = item["place"] >> PLACE_BITS, item["mask"]
        for i in range(RUN):
            if mask >> i & 1:
                change[start + i] += 1
                change[start + i + WINDOW] -= 1
    return np.cumsum(change)[:n_words] == 0


def _kept(docs: DataFrame, finish, schema: str) -> DataFrame:
    keyed = _keyed(docs)
    joined = keyed.join(repeated_runs(keyed), ["a", "b"], "left").select("doc_id", "text", "found")

    def start():
        def work(doc_id, text, found):
            words = _words(text)
            keep = keep_mask(len(words), found)
            kept = words if keep.all() else [w for w, k in zip(words, keep.tolist(), strict=True) if k]
            return [(doc_id, len(words), len(words) - len(kept), finish(b" ".join(kept)))]

        return work

    return _map(joined, start, schema)


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words of each document, joined by blanks."""
    return _kept(docs, bytes.decode, "doc_id long,n_words long,n_removed long,kept string")


def scan_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and the digest of the kept words."""
    return _kept(docs, lambda kept: hashlib.sha256(kept).hexdigest(), "doc_id long,n_words long,n_removed long,kept_sha256 string")
