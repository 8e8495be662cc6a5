"""Byte-level BPE by merge ranks over whole texts, long ones in overlapping chunks (operator 13).

A text is cut into pre-tokens by the public pattern and the bytes of each are merged by rank, lowest rank first and
leftmost among equals. A text longer than a chunk is cut into chunks that overlap:

1. Chunks are dealt to tasks and each is pre-tokenised from its own first character, which may stand inside a pre-token.
2. A text's chunks are read in order. The pattern looks ahead by at most LOOKAHEAD characters and never back, so a
   boundary that far from the end of the text seen is certain, and two cuts that share one boundary agree from there
   on. Where the last certain boundary is one of the next chunk's, that chunk's cut is taken over; otherwise the text
   is cut on from the last certain boundary until a boundary is shared. The overlap makes the first case the rule; the
   second makes the result exact for pre-tokens of any length.
3. The pieces are encoded as they become certain, and decoding concatenates the raw bytes of the tokens.

A task holds one chunk, the pieces it has become certain of and the piece that is still open. Texts that are equal are
encoded once. Rows are joined with their text's result by a 256-bit digest.

Nulls count as the empty text, which has no tokens; a text has no special tokens. Repeated rows give repeated results, a
null doc_id stays null, an empty table gives no rows, and other columns are ignored whatever their names. Letters and
numbers are those of the `regex` module's Unicode tables.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.bpe import PIECES
from paperloom.llm.tables import arrow_schema, id_text, map_texts

CHUNK = 32_768  # characters a chunk owns; longer texts are cut
OVERLAP = 512  # characters a chunk has in common with the next one
LOOKAHEAD = 2  # characters behind a pre-token that decide where it ends ('ll against ')
CACHED_PIECES = 400_000  # pre-tokens whose tokens a task remembers; the older half is forgotten beyond it
LONGEST_CACHED = 64  # characters of such a pre-token
SHORT_MERGE = 48  # bytes up to which a pre-token is merged by plain search

SPLIT = regex.compile(PIECES)
CHUNKS = "key binary,part int,begin long,last boolean,text string"
CUT_CHUNKS = f"{CHUNKS},ends binary"


class RankCodec(dict):
    """Encoder and decoder of one rank file; as a dictionary it holds the tokens of the pre-tokens seen."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, "rb") as file:
            pairs = [line.split() for line in file if line.strip()]
        self.ranks = {base64.b64decode(word): int(rank) for word, rank in pairs}
        self.longest = max(map(len, self.ranks))
        size = 1 + max(self.ranks.values())
        self.raw = [b""] * size
        for word, rank in self.ranks.items():
            self.raw[rank] = word
        self.decimal = [str(rank) for rank in range(size)]

    def __missing__(self, piece: str) -> tuple[int, ...]:
        tokens = tuple(self.encode_piece(piece.encode()))
        if len(piece) <= LONGEST_CACHED:
            if len(self) >= CACHED_PIECES:
                for old in list(islice(self, CACHED_PIECES // 2)):
                    del self[old]
            self[piece] = tokens
        return tokens

    def encode_piece(self, raw: bytes) -> list[int]:
        """Tokens of the bytes of one pre-token."""
        whole = self.ranks.get(raw)
        if whole is not None:
            return [whole]
        return self._merge_short(raw) if len(raw) <= SHORT_MERGE else self._merge_long(raw)

    def _merge_short(self, raw: bytes) -> list[int]:
        rank = self.ranks.get
        parts = [raw[i : i + 1] for i in range(len(raw))]
        none = len(self.raw)
        pairs = [rank(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
        while pairs:
            least = min(pairs)
            if least == none:
                break
            i = pairs.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = rank(parts[i] + parts[i + 1], none)
            if i:
                pairs[i - 1] = rank(parts[i - 1] + parts[i], none)
        return [self.ranks[part] for part in parts]

    def _merge_long(self, raw: bytes) -> list[int]:
        """The same merges from a queue; a part is named by its first byte and `stop` is where it ends (0: merged away)."""
        ranks, longest, n = self.ranks, self.longest, len(raw)
        stop, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := ranks.get(raw[i : i + 2])) is not None]
        heapq.heapify(queue)

        def offer(left: int, middle: int, end: int) -> None:
            if end - left <= longest:
                r = ranks.get(raw[left:end])
                if r is not None:
                    heapq.heappush(queue, (r, left, middle, end))

        while queue:
            _, left, middle, end = heapq.heappop(queue)
            if stop[left] != middle or stop[middle] != end:
                continue
            stop[left], stop[middle] = end, 0
            if end < n:
                before[end] = left
                offer(left, end, stop[end])
            if before[left] >= 0:
                offer(before[left], left, end)
        out, at = [], 0
        while at < n:
            out.append(ranks[raw[at : stop[at]]])
            at = stop[at]
        return out

    def encode(self, pieces: Iterable[str]) -> list[int]:
        return list(chain.from_iterable(map(self.__getitem__, pieces)))

    def decode(self, ids: Iterable[int]) -> bytes:
        """The raw bytes of token ids; they need not be whole characters."""
        return b"".join(map(self.raw.__getitem__, ids))


class Stitch:
    """The pre-tokens of one text from the cuts of its chunks, which come in order."""

    def __init__(self):
        self.at = 0  # the last certain boundary
        self.open = ""  # the text from there to the end of the chunks seen
        self.rest: list[str] = []  # text that came after it while no boundary was found
        self.waiting = 0  # characters that the last fruitless search went through

    def feed(self, begin: int, text: str, ends: list[int], last: bool) -> list[str]:
        """The pieces that chunk `text` makes certain; `ends` are the ends of its own pieces, counted from `begin`."""
        out: list[str] = []
        limit = begin + len(text) - (0 if last else LOOKAHEAD)
        seen = self.at + len(self.open) + sum(map(len, self.rest))
        here = self.at - begin
        shared = here == 0 or (here > 0 and _holds(ends, here))
        if not shared:
            self.rest.append(text[seen - begin :])
            size = len(self.open) + sum(map(len, self.rest))
            if not last and size < 2 * self.waiting:
                return out  # a long piece is searched again only when its text has doubled
            joined = "".join([self.open, *self.rest])
            start = self.at
            for match in SPLIT.finditer(joined):
                end = start + match.end()
                if end > limit:
                    break
                out.append(match.group())
                self.at = end
                if _holds(ends, end - begin):
                    shared = True
                    break
            if not shared:
                self.open, self.rest = joined[self.at - start :], []
                self.waiting = len(self.open)
                return out
        at = self.at - begin
        own = ends[bisect_right(ends, at) : bisect_right(ends, limit - begin)]
        for end in own:
            out.append(text[at:end])
            at = end
        self.at, self.open, self.rest, self.waiting = begin + at, text[at:], [], 0
        return out


def _holds(ends: list[int], place: int) -> bool:
    i = bisect_left(ends, place)
    return i < len(ends) and ends[i] == place


def chunk_ends(text: str) -> list[int]:
    """Ends of the pre-tokens of a chunk, cut from its first character."""
    return [match.end() for match in SPLIT.finditer(text)]


def chunks_of(text: str, chunk: int, overlap: int) -> Iterator[tuple[int, int, bool, str]]:
    """(part, begin, last, text) of the overlapping chunks."""
    for part, begin in enumerate(range(0, len(text), chunk)):
        last = begin + chunk >= len(text)
        yield part, begin, last, text[begin : begin + chunk + (0 if last else overlap)]


class Digests:
    """Count and digests of one text's tokens, folded piece by piece."""

    SCHEMA = "n_tokens long,ids_sha256 string,decoded_sha256 string"

    def __init__(self, codec: RankCodec):
        self.codec, self.n = codec, 0
        self.ids, self.decoded = hashlib.sha256(), hashlib.sha256()

    def add(self, pieces: Iterable[str]) -> None:
        ids = self.codec.encode(pieces)
        if ids:
            self.ids.update(((" " if self.n else "") + " ".join(map(self.codec.decimal.__getitem__, ids))).encode())
            self.decoded.update(self.codec.decode(ids))
            self.n += len(ids)

    def values(self) -> tuple:
        return self.n, self.ids.hexdigest(), self.decoded.hexdigest()


class Ids:
    """The token ids of one text."""

    SCHEMA = "ids array<int>"

    def __init__(self, codec: RankCodec):
        self.codec, self.parts = codec, []

    def add(self, pieces: Iterable[str]) -> None:
        self.parts.append(np.array(self.codec.encode(pieces), np.int32))

    def values(self) -> tuple:
        return (np.concatenate([np.zeros(0, np.int32), *self.parts]),)


def _cut(chunk: int, overlap: int):
    """Chunks of long texts, each named by the digest of its whole text."""

    def run(batches):
        kinds = arrow_schema(CHUNKS)
        for batch in batches:
            for text in batch.column(0):
                text = text.as_py()
                key = hashlib.sha256(text.encode()).digest()
                rows = [(key, part, begin, last, own) for part, begin, last, own in chunks_of(text, chunk, overlap)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], schema=kinds)

    return run


def _pretokenise(batches):
    kinds = arrow_schema(CUT_CHUNKS)
    for batch in batches:
        ends = [np.array(chunk_ends(text.as_py()), "<i4").tobytes() for text in batch.column(4)]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ends, pa.binary())], schema=kinds)


def _stitched(path: str, fold: Callable, schema: str):
    """One row per key from its chunks, which come in order."""

    def run(batches):
        codec, kinds = RankCodec(path), arrow_schema(schema)
        key = stitch = state = None
        for batch in batches:
            for i in range(batch.num_rows):
                own, _, begin, last, text, ends = (batch.column(c)[i].as_py() for c in range(6))
                if own != key:
                    key, stitch, state = own, Stitch(), fold(codec)
                state.add(stitch.feed(begin, text, np.frombuffer(ends, "<i4").tolist(), last))
                if last:
                    values = [[key], *([value] for value in state.values())]
                    yield pa.RecordBatch.from_arrays([pa.array(v, k.type) for v, k in zip(values, kinds, strict=True)], schema=kinds)

    return run


def _over_texts(narrow: DataFrame, path: str, fold: Callable, chunk: int, overlap: int) -> DataFrame:
    """doc_id and what `fold` makes of the pieces of each whole text."""
    size = F.length(F.coalesce("text", F.lit("")))

    def start():
        codec = RankCodec(path)

        def work(text):
            state = fold(codec)
            state.add(SPLIT.findall(text or ""))
            return state.values()

        return work

    short = map_texts(narrow.where(size <= chunk), start, f"doc_id long,{fold.SCHEMA}")
    long = narrow.where(size > chunk)
    schema = f"key binary,{fold.SCHEMA}"
    results = (
        long.select("text").mapInArrow(_cut(chunk, overlap), CHUNKS).dropDuplicates(["key", "part"])
        .mapInArrow(_pretokenise, CUT_CHUNKS).repartition("key").sortWithinPartitions("key", "part")
        .mapInArrow(_stitched(path, fold, schema), schema)
    )
    keyed = long.select("doc_id", F.unhex(F.sha2("text", 256)).alias("key"))
    return short.unionByName(keyed.join(results, "key").drop("key"))


def encode_documents(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP,
) -> DataFrame:
    """doc_id and the token ids of each whole text. `path` is a rank file every executor has."""
    return _over_texts(id_text(docs, id_col, text_col), path, Ids, chunk, overlap)


def decode_documents(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and the raw bytes of token id arrays (null: none)."""

    def start():
        codec = RankCodec(path)
        return lambda ids: (codec.decode(ids or []),)

    frame = encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids"))
    return map_texts(frame, start, "doc_id long,raw binary")


def round_trip_digests(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP,
) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (decimal ids joined by one space) and decoded_sha256 of each whole text."""
    return _over_texts(id_text(docs, id_col, text_col), path, Digests, chunk, overlap)
