"""Runs (maximal repetitions) in the words of whole texts (operator 12).

A run is a stretch of consecutive words with smallest period q and at least two periods that no neighbouring word extends.
For each stretch of text that can hold runs:

1. Ukkonen's algorithm builds the suffix tree of the stretch and that of its reversal.
2. An Euler tour visits the leaves in the order of their suffixes; the depth at which the tour turns between two leaves is
   that of their lowest common ancestor. A table of minima over powers of two then answers each longest common extension
   (LCE) in constant time, to the right in the first tree and to the left in the second.
3. Each word starts one longest Lyndon word in the order of the words and one in the opposite order; they end at the next
   smaller and the next greater suffix. These Lyndon words hold a root of every run, so each is extended in both
   directions by its own length as period, and the extensions that are long enough are the runs.

Only stretches that can hold runs are looked at: in a run of at least L words, every word lies in a window of
ceil(L / 2) words that stands in the stretch twice. Stretches are cut where no such window covers a word, until nothing
changes; windows are compared by 64-bit hashes, and equal hashes of different windows only leave a stretch longer. So
no run is lost and none is cut, and text without repetition costs one sort.

Nulls and blank texts have no words and no runs. A text is worked on in one task, in memory linear in its words (times
the logarithm for the table). Repeated rows give repeated results, a null doc_id stays null, an empty table gives no
rows, and other columns are ignored whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from paperloom.llm.tables import arrow_schema, id_text

LEAST = 12  # words of a run
HASH = np.uint64(0x9E3779B97F4A7C15)
RUNS = "doc_id long,start long,length long,period long"
COLLAPSED = "doc_id long,text string"
DIGESTS = (
    "doc_id long,n_runs long,start long,length long,period long,exponent_milli long,runs_sha256 string,collapsed_sha256 string"
)


class SuffixTree:
    """Suffix tree of a list of positive numbers, built by Ukkonen's algorithm.

    `rank` is the place of each suffix in sorted order (the empty one first) and `turns` the depth of the lowest common
    ancestor of each two neighbours in that order.
    """

    def __init__(self, symbols: list[int]):
        s = [*symbols, 0]  # the end is a symbol of its own, smaller than all
        n, sigma = len(s), max(s) + 1
        begin, stop, link, child = [0], [0], [0], {}
        leaves: list[int] = []
        find = child.get
        active = edge = length = left = 0
        for i in range(n):
            c = s[i]
            open_node = 0  # inner node whose suffix link is not known yet
            left += 1
            while left:
                if not length:
                    edge = i
                key = active * sigma + s[edge]
                below = find(key)
                if below is None:
                    child[key] = node = len(begin)
                    begin.append(i)
                    stop.append(n)
                    link.append(0)
                    leaves.append(node)
                    if open_node:
                        link[open_node] = active
                        open_node = 0
                else:
                    first = begin[below]
                    size = stop[below] - first
                    if length >= size:
                        edge += size
                        length -= size
                        active = below
                        continue
                    if s[first + length] == c:
                        length += 1
                        if open_node:
                            link[open_node] = active
                        break
                    middle = first + length
                    node = len(begin)
                    begin += (first, i)
                    stop += (middle, n)
                    link += (0, 0)
                    child[key] = node
                    child[node * sigma + c] = node + 1
                    child[node * sigma + s[middle]] = below
                    begin[below] = middle
                    leaves.append(node + 1)
                    if open_node:
                        link[open_node] = node
                    open_node = node
                left -= 1
                if active:
                    active = link[active]
                elif length:
                    length -= 1
                    edge = i - left + 1
        self._visit(np.array(begin), np.array(stop), child, sigma, leaves)

    def _visit(self, begin, stop, child, sigma, leaves):
        """Euler tour: leaves in order and the depths at which the tour turns between them."""
        keys = np.fromiter(child.keys(), np.int64, len(child))
        nodes = np.fromiter(child.values(), np.int64, len(child))
        order = np.argsort(-keys)  # by node and symbol, last symbol first, as the stack takes the last entry first
        keys, nodes = keys[order], nodes[order]
        above = np.zeros(len(begin), np.int64)
        above[nodes] = keys // sigma
        depth, far = stop - begin, above
        while far.any():  # sums of edge lengths up to the root, by doubling the step
            depth, far = depth + depth[far], far[far]
        # Where the children of each node stand in `nodes`.
        counts = np.bincount(above[nodes], minlength=len(begin))[::-1]
        ends = np.cumsum(counts)[::-1]
        low, high, flat = (ends - counts[::-1]).tolist(), ends.tolist(), nodes.tolist()
        tour, stack = [], [0]
        pop, note, push = stack.pop, tour.append, stack.extend
        while stack:
            node = pop()
            note(node)
            a, b = low[node], high[node]
            if a < b:
                push(flat[a:b])
        tour = np.array(tour)
        suffix = np.full(len(begin), -1)
        suffix[leaves] = np.arange(len(leaves))
        at = np.flatnonzero(suffix[tour] >= 0)
        self.rank = np.empty(len(leaves), np.int64)
        self.rank[suffix[tour[at]]] = np.arange(len(at))
        # After a leaf the tour goes up to the parent of the node that it visits next.
        self.table = [depth[above[tour[at[:-1] + 1]]].astype(np.int32)]
        while 2 ** len(self.table) <= len(self.table[0]):
            last, step = self.table[-1], 2 ** (len(self.table) - 1)
            self.table.append(np.minimum(last[:-step], last[step:]))

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes at i and at j, where no i equals its j."""
        a, b = self.rank[i], self.rank[j]
        a, b = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((b - a).astype(np.float64))[1] - 1
        out = np.empty(len(a), np.int64)
        for k in range(len(self.table)):
            at = np.flatnonzero(level == k)
            if len(at):
                out[at] = np.minimum(self.table[k][a[at]], self.table[k][b[at] - 2**k])
        return out


def _next_beyond(values: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """For each place the next one with a smaller value and the next one with a greater value (-1: none)."""
    smaller, greater = [-1] * len(values), [-1] * len(values)
    down: list[int] = []
    up: list[int] = []
    for i, value in enumerate(values):
        while down and values[down[-1]] > value:
            smaller[down.pop()] = i
        down.append(i)
        while up and values[up[-1]] < value:
            greater[up.pop()] = i
        up.append(i)
    return np.array(smaller), np.array(greater)


def _runs_of_stretch(ids: np.ndarray, least: int) -> np.ndarray:
    """Rows (start, length, period) of all runs of at least `least` words, in no order."""
    n = len(ids)
    symbols = (np.unique(ids, return_inverse=True)[1] + 1).tolist()
    right = SuffixTree(symbols)
    smaller, greater = _next_beyond(right.rank.tolist())
    starts = np.concatenate([np.arange(n), np.arange(n)])
    stops = np.concatenate([smaller[:n], greater[:n]])
    starts, stops = starts[stops > 0], stops[stops > 0]
    period = stops - starts
    ahead = right.common(starts, stops)
    del right
    left = SuffixTree(symbols[::-1])
    behind = left.common(n - starts, n - stops)
    length = behind + period + ahead
    long = (length >= 2 * period) & (length >= least)
    rows = np.stack([starts - behind, length, period], axis=1)[long]
    return np.unique(rows, axis=0)


def _stretches(ids: np.ndarray, width: int) -> list[tuple[int, int]]:
    """Parts of the words in which every word lies in a window of `width` words that stands twice in the part."""
    todo, done = [(0, len(ids))], []
    while todo:
        low, high = todo.pop()
        n = high - low - width + 1
        if n < 2:
            continue
        own = ids[low:high].astype(np.uint64)
        hashes = own[:n].copy()
        for k in range(1, width):
            hashes = hashes * HASH + own[k : k + n]
        hashes ^= hashes >> np.uint64(29)
        order = np.argsort(hashes, kind="stable")
        same = np.flatnonzero(hashes[order[1:]] == hashes[order[:-1]])
        if not len(same):
            continue
        change = np.zeros(high - low + 1, np.int64)
        twice = np.zeros(n, bool)
        twice[order[same]] = twice[order[same + 1]] = True
        at = np.flatnonzero(twice)
        change[at] += 1
        change[at + width] -= 1
        covered = np.concatenate([[False], np.cumsum(change[:-1]) > 0, [False]])
        edges = np.flatnonzero(covered[1:] != covered[:-1]) + low
        parts = list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))
        (done if parts == [(low, high)] else todo).extend(parts)
    return done


def runs(words: list, least: int = LEAST) -> np.ndarray:
    """Rows (start, length, period) of all runs of at least `least` words, by start, then period."""
    none = np.zeros((0, 3), np.int64)
    n = len(words)
    if n < max(2, least):
        return none
    number = dict(zip(words, range(n), strict=True))
    if len(number) == n:
        return none
    ids = np.fromiter(map(number.__getitem__, words), np.int64, n)
    found = [none]
    for low, high in _stretches(ids, max(1, (least + 1) // 2)):
        if high - low >= max(2, least):
            found.append(_runs_of_stretch(ids[low:high], least) + [low, 0, 0])
    rows = np.concatenate(found)
    return rows[np.lexsort([rows[:, 2], rows[:, 0]])]


def collapsed(words: list, found: np.ndarray) -> list:
    """The words that no run contains after its first period."""
    if not len(found):
        return words
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, found[:, 0] + found[:, 2], 1)
    np.add.at(change, found[:, 0] + found[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def with_period(doc_id: int | None, words: list) -> list:
    """The words, of which a tenth of all documents repeat a part to the end; chosen by the checksum of the id."""
    h = zlib.crc32(str(doc_id).encode())
    n = len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    part = words[a : a + p]
    return words[:a] + (part * (1 + (n - a) // p))[: n - a]


def _map_documents(docs: DataFrame, work: Callable, schema: str) -> DataFrame:
    """Rows that `work` makes of doc_id and text of each row, as lists of columns."""

    def run(batches):
        kinds = arrow_schema(schema)
        for batch in batches:
            rows = [row for i in range(batch.num_rows) for row in work(batch.column(0)[i].as_py(), batch.column(1)[i].as_py())]
            columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(columns, kinds, strict=True)], schema=kinds)

    return docs.mapInArrow(run, schema)


def find_runs(docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, start, length and period of every run of each whole text."""

    def work(doc_id, text):
        return [(doc_id, *row) for row in runs(words_of(text), least).tolist()]

    return _map_documents(id_text(docs, id_col, text_col), work, RUNS)


def collapse_runs(docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and text of each row, where a run is cut to its first period; texts without a run are kept as they are."""

    def work(doc_id, text):
        words = words_of(text)
        found = runs(words, least)
        return [(doc_id, b" ".join(collapsed(words, found)).decode() if len(found) else text)]

    return _map_documents(id_text(docs, id_col, text_col), work, COLLAPSED)


def scan_documents(
    docs: DataFrame, least: int = LEAST, change: Callable = with_period, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Number of runs, the longest one, and digests of all runs and of the words left; `change` alters the words first."""

    def work(doc_id, text):
        words = change(doc_id, words_of(text))
        found = runs(words, least)
        best = [None] * 4
        if len(found):
            start, length, period = found[np.lexsort([found[:, 2], found[:, 0], -found[:, 1]])[0]].tolist()
            best = [start, length, period, 1000 * length // period]
        listed = "".join(f"{a},{b},{c}\n" for a, b, c in found.tolist())
        kept = b" ".join(collapsed(words, found))
        return [(doc_id, len(found), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())]

    return _map_documents(id_text(docs, id_col, text_col), work, DIGESTS)
