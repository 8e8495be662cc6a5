"""Byte-pair encoding and decoding of whole texts (operator 4).

Encoding is exact and linear in the text: an Aho-Corasick automaton gives the longest token that starts at each byte of
a piece; tokens are taken greedily, a token may follow another only if the pair is compatible (their joined bytes
encode to just these two tokens), and otherwise a shorter token is tried or the last token is taken back. A byte
position from which no continuation exists is remembered, so each is left at most once.

Decoding gathers token bytes from one byte table by an offset table.

Nulls count as the empty text; an empty text has no tokens. Repeated rows give repeated results. Other columns of the
input are ignored. The special token's string in a text is the special token, as the tokenizers library has it by
default. Letters and numbers are those of the `regex` module's Unicode tables; the library's tables are one version
older, so code points first assigned in Unicode 17 may be cut differently.
"""

from __future__ import annotations

import hashlib
import json
from itertools import islice

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame

from paperloom.llm.tables import id_text, map_texts

# White space as the pre-tokeniser knows it (fixed values: Unicode White_Space).
SPACE = r"\t-\r \x85\xa0  -     　"
# The public split pattern of byte-level BPE (fixed value), with white space written out.
PIECES = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
CACHED_PIECES = 400_000  # pieces whose tokens a task remembers; the older half is forgotten beyond it
LONGEST_CACHED = 64  # characters of such a piece
CACHED_PAIRS = 1_000_000  # pairs whose compatibility a task remembers


def _byte_of_char() -> dict[str, int]:
    """The public byte-to-printable-character table of byte-level BPE: printable bytes stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Pieces(dict):
    """Tokens (little-endian 32-bit bytes) of each piece seen, filled on demand and bounded."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, piece):
        tokens = np.array(self.encode(piece.encode()), "<u4").tobytes()
        if len(piece) <= LONGEST_CACHED:
            if len(self) >= CACHED_PIECES:
                for old in list(islice(self, CACHED_PIECES // 2)):
                    del self[old]
            self[piece] = tokens
        return tokens


class BpeCodec:
    """Encoder and decoder of one tokenizers JSON file of the byte-level BPE kind."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte_of = _byte_of_char()
        vocab = spec["model"]["vocab"]
        size = 1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])])
        self.token_bytes: list[bytes] = [b""] * size
        for word, token in vocab.items():
            self.token_bytes[token] = bytes(byte_of[c] for c in word)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for content, token in self.special.items():
            self.token_bytes[token] = content.encode()
        self.special_split = regex.compile("|".join(f"({regex.escape(c)})" for c in self.special)) if self.special else None
        special_ids = set(self.special.values())
        self.by_bytes = {b: t for t, b in enumerate(self.token_bytes) if b and t not in special_ids}
        # How each token is made: the rank of its merge (-1: a single byte) and the two parts.
        self.rank, self.left, self.right = [-1] * size, list(range(size)), list(range(size))
        self.merged: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            token = vocab[a + b]
            self.merged[vocab[a], vocab[b]] = rank, token
            if self.rank[token] < 0:
                self.rank[token], self.left[token], self.right[token] = rank, vocab[a], vocab[b]
        self.automaton = ahocorasick.Automaton()
        for raw, token in self.by_bytes.items():
            self.automaton.add_word(raw.decode("latin-1"), (token, len(raw)))
        self.automaton.make_automaton()
        self.shorter = [self._shorter(raw) for raw in self.token_bytes]
        self.pairs: dict[tuple[int, int], bool] = {}
        self.pieces = _Pieces(self._encode_piece)
        self.split = regex.compile(PIECES)
        # Offset table for decoding.
        self.lengths = np.array([len(b) for b in self.token_bytes], np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.table = np.frombuffer(b"".join(self.token_bytes), np.uint8)

    def _shorter(self, raw: bytes) -> int:
        """The longest token that is a proper prefix of these bytes, or -1."""
        return next((self.by_bytes[raw[:n]] for n in range(len(raw) - 1, 0, -1) if raw[:n] in self.by_bytes), -1)

    def _compatible(self, a: int, b: int) -> bool:
        """Whether the joined bytes of the two tokens encode to the two tokens.

        Undo the merges of both tokens at their border from the latest on. The border stays closed only if no merge
        across it ever had its turn before the next merge beside it.
        """
        key = a, b
        known = self.pairs.get(key)
        if known is not None:
            return known
        if len(self.pairs) >= CACHED_PAIRS:
            self.pairs.clear()
        rank, left, right = self.rank, self.left, self.right
        # What across the border had to wait for: a merge on the right side goes later than one across of equal rank.
        limit, fine = float("inf"), True
        while True:
            across = self.merged.get((a, b))
            if across is not None and across[0] < limit:
                fine = False
                break
            if rank[a] < 0 and rank[b] < 0:
                break
            if rank[a] > rank[b]:
                limit, a = rank[a], right[a]
            else:
                limit, b = rank[b] + 0.5, left[b]
        self.pairs[key] = fine
        return fine

    def _encode_piece(self, raw: bytes) -> list[int]:
        whole = self.by_bytes.get(raw)
        if whole is not None:
            return [whole]
        longest = [-1] * (len(raw) + 1)
        for end, (token, length) in self.automaton.iter(raw.decode("latin-1")):
            longest[end - length + 1] = token
        lengths, shorter, compatible, pairs = self.token_bytes, self.shorter, self._compatible, self.pairs
        closed = bytearray(len(raw) + 1)
        tokens: list[int] = []
        at, token = 0, longest[0]
        while at < len(raw):
            last = tokens[-1] if tokens else -1
            while token >= 0:
                end = at + len(lengths[token])
                if not closed[end]:
                    if last < 0:
                        break
                    fits = pairs.get((last, token))
                    if fits or (fits is None and compatible(last, token)):
                        break
                token = shorter[token]
            if token >= 0:
                tokens.append(token)
                at, token = end, longest[end]
            else:
                closed[at] = 1
                token = tokens.pop()
                at -= len(lengths[token])
        return tokens

    def encode(self, text: str) -> bytes:
        """Token ids of a text as little-endian unsigned 32-bit integers."""
        parts = self.special_split.split(text) if self.special_split else [text]
        get, find = self.pieces.__getitem__, self.split.findall
        out = []
        for part in parts:
            if part in self.special:
                out.append(self.special[part].to_bytes(4, "little"))
            elif part:
                out.append(b"".join(map(get, find(part))))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """Text of token ids; bytes that aren't UTF-8 become replacement characters."""
        tokens = np.frombuffer(ids, "<u4")
        if not len(tokens):
            return ""
        lengths = self.lengths[tokens]
        ends = np.cumsum(lengths)
        gather = np.repeat(self.offsets[tokens] - (ends - lengths), lengths)
        gather += np.arange(ends[-1])
        return self.table[gather].tobytes().decode("utf-8", "replace")


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the token ids of each whole text. `path` is a tokenizers JSON file every executor has."""

    def start():
        codec = BpeCodec(path)
        return lambda text: (np.frombuffer(codec.encode(text or ""), "<u4").astype(np.int32),)

    return map_texts(id_text(docs, id_col, text_col), start, "doc_id long,ids array<int>")


def decode_documents(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and text of token id arrays (null: empty)."""

    def start():
        codec = BpeCodec(path)
        return lambda ids: (codec.decode(np.array(ids or [], "<u4").tobytes()),)

    frame = encoded.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"`{ids_col}` as ids")
    return map_texts(frame, start, "doc_id long,text string")


def round_trip_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode each whole text in one pass and return only count and digests, so that no ids leave the task."""

    def start():
        codec = BpeCodec(path)

        def digests(text):
            ids = codec.encode(text or "")
            decoded = codec.decode(ids)
            return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()

        return digests

    return map_texts(
        id_text(docs, id_col, text_col), start, "doc_id long,n_tokens long,ids_sha256 string,decoded_sha256 string"
    )
