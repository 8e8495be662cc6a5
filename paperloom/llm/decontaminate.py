"""Benchmark decontamination by pigeonhole edit matching (operator 10).

Texts are lower-cased and cut into words. Every item is matched as a whole, whatever its length: it may differ from a
stretch of a document by at most a fifth of its words (edits of whole words, rounded down; none in an item under five
words). Beside that, each passage of PASSAGE words of a longer item, at every STRIDE words and at the end, is matched in
the same way, so that a quotation is found as well; column `whole` tells the two apart. A pattern is cut into
error-budget-plus-one pieces: a place within the budget must hold one piece unchanged. An Aho-Corasick automaton finds
the piece hits in one pass over a text; the words around a hit are verified with Myers' bit-parallel edit distance. Both
are exact for the stated budget.

The automaton travels with the tasks while the benchmark is within MAX_BYTES; a larger benchmark is worked on in parts
of that size, one pass over the documents each.

Nulls count as the empty text. Items with a null id, a null text or without a word match nothing; `least_words` leaves
shorter items out. Repeated documents give repeated results, repeated items don't: an item is reported once per document,
as a whole if it is found as a whole, with its least distance there and the earliest such place. Other columns are
ignored.
"""

from __future__ import annotations

import functools
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.tables import arrow_schema, id_text
from paperloom.session import durable

PASSAGE, STRIDE = 32, 16  # words of a passage, and between the starts of two
BUDGET = 0.2  # word edits per word of a passage
MAX_BYTES = 8_000_000  # of benchmark text that travels with the tasks at once
SCHEMA = "doc_id long,item_id long,distance long,first_word long,last_word long,whole boolean"
_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def distance_ends(masks: dict[str, int], length: int, words: list[str]) -> Iterator[tuple[int, int]]:
    """Myers: for each word, the least edit distance of the pattern to any stretch that ends there, and the place."""
    full, top = (1 << length) - 1, 1 << (length - 1)
    plus, minus, score = full, 0, length
    for at, word in enumerate(words):
        equal = masks.get(word, 0)
        vertical = equal | minus
        horizontal = (((equal & plus) + plus) ^ plus) | equal
        up, down = minus | ~(horizontal | plus), plus & horizontal
        score += bool(up & top) - bool(down & top)
        up, down = (up << 1) & full, (down << 1) & full
        plus, minus = (down | ~(vertical | up)) & full, up & vertical
        yield score, at


@dataclass
class Passage:
    item: int
    words: list[str]
    budget: int
    masks: dict[str, int]
    whole: bool


class Matcher:
    """Pieces of all passages in one automaton."""

    def __init__(self, items: list[tuple[int, str]], least_words: int = 1):
        self.passages: list[Passage] = []
        pieces: dict[str, list[tuple[int, int]]] = {}
        for item, text in items:
            words = words_of(text)
            if len(words) < max(1, least_words):
                continue
            self._add(item, words, True, pieces)
            last = len(words) - PASSAGE
            for low in sorted({*range(0, last, STRIDE), last}) if last > 0 else ():
                self._add(item, words[low : low + PASSAGE], False, pieces)
        self.automaton = ahocorasick.Automaton()
        for piece, owners in pieces.items():
            self.automaton.add_word(piece, (len(piece), owners))
        self.automaton.make_automaton()
        self.empty = not pieces

    def _add(self, item: int, words: list[str], whole: bool, pieces: dict) -> None:
        budget = int(len(words) * BUDGET)
        masks: dict[str, int] = {}
        for i, word in enumerate(words):
            masks[word] = masks.get(word, 0) | 1 << i
        number = len(self.passages)
        self.passages.append(Passage(item, words, budget, masks, whole))
        cuts = [len(words) * i // (budget + 1) for i in range(budget + 2)]
        for low, high in zip(cuts, cuts[1:], strict=False):
            pieces.setdefault(f" {' '.join(words[low:high])} ", []).append((number, low))

    def matches(self, text: str | None) -> list[tuple[int, int, int, int, bool]]:
        """item, distance, first and last word (by pattern length) of each item's best place in the text, and whether whole."""
        words = words_of(text)
        if self.empty or not words:
            return []
        joined = f" {' '.join(words)} "
        starts, tried = None, set()
        best: dict[int, tuple[bool, int, int, int]] = {}
        for end, (length, owners) in self.automaton.iter(joined):
            if starts is None:
                sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
                starts = (np.cumsum(sizes) - sizes).tolist()
            at = bisect_right(starts, end - length + 1) - 1
            for number, offset in owners:
                begin = at - offset
                if (number, begin) in tried:
                    continue
                tried.add((number, begin))
                passage = self.passages[number]
                low = max(0, begin - passage.budget)
                stretch = words[low : begin + len(passage.words) + passage.budget]
                score, place = min(distance_ends(passage.masks, len(passage.words), stretch))
                if score <= passage.budget:
                    last = low + place
                    found = not passage.whole, score, max(0, last - len(passage.words) + 1), last
                    best[passage.item] = min(best.get(passage.item, found), found)
        return [(item, *found, not part) for item, (part, *found) in sorted(best.items())]


def _parts(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The usable items, in parts of bounded size."""
    usable = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    size = usable.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = 1 + size // (MAX_BYTES // 2)
    for i in range(n):
        part = usable if n == 1 else usable.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == i)
        yield [(row.item_id, row.text) for row in part.collect()]


def leaks(docs: DataFrame, benchmark: DataFrame, least_words: int = 1) -> DataFrame:
    """doc_id, item_id, distance, first_word, last_word, whole of every benchmark item found in a whole text."""
    narrow = id_text(docs)

    def scan(items):
        def run(batches):
            matcher = Matcher(items, least_words)
            kinds = arrow_schema(SCHEMA)
            for batch in batches:
                rows = [(batch.column(0)[i].as_py(), *m) for i in range(batch.num_rows) for m in matcher.matches(batch.column(1)[i].as_py())]
                columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(columns, kinds, strict=True)], schema=kinds)

        return narrow.mapInArrow(run, SCHEMA)

    return functools.reduce(DataFrame.unionByName, map(scan, _parts(benchmark)))


def without_leaks(docs: DataFrame, benchmark: DataFrame, least_words: int = 1) -> DataFrame:
    """The rows of `docs`, unchanged, whose text holds no benchmark item."""
    for i, items in enumerate(_parts(benchmark)):
        if i:
            docs = durable(docs)
        docs = docs.where(_clean(items, least_words)(F.col("text")))
    return docs


def _clean(items: list[tuple[int, str]], least_words: int):
    made: list[Matcher] = []

    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        if not made:
            made.append(Matcher(items, least_words))
        return pd.Series([not made[0].matches(t) for t in texts], dtype="boolean")

    return clean
