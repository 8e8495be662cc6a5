import collections
import functools
import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from paperloom.llm import bpe
from paperloom.llm.queries import TOKENIZER


@pytest.fixture(scope="module")
def codec():
    return bpe.BpeCodec(TOKENIZER)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(TOKENIZER)


def _ids(codec, text):
    return np.frombuffer(codec.encode(text), "<u4").tolist()


@functools.cache
def _both():
    return bpe.BpeCodec(TOKENIZER), Tokenizer.from_file(TOKENIZER)


WIDE = st.text(alphabet=st.characters(max_codepoint=0x24FF, exclude_categories=("Cs", "Cn")), max_size=80)
NARROW = st.text(alphabet="aAbe tinorh'\n", max_size=60)


@settings(max_examples=600, deadline=None)
@given(st.one_of(WIDE, NARROW))
def test_equals_library(text):
    codec, library = _both()
    assert _ids(codec, text) == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize(
    "text",
    ["", " ", "\x1c\x85  a", "<|endoftext|>", "a<|endoftext|> <|endoftext|>b", "é漢字\U0001f600", "a" * 5000, " " * 3000, "ab" * 4000, "it's 12'll\r\n\n x"],
)
def test_cases(codec, library, text):
    expected = library.encode(text, add_special_tokens=False).ids
    assert _ids(codec, text) == expected
    assert codec.decode(codec.encode(text)) == library.decode(expected, skip_special_tokens=False)


def test_every_token_is_its_own_encoding(codec):
    """The greedy step takes a whole token at once, which is exact only if each token encodes to itself."""
    wrong = [t for raw, t in codec.by_bytes.items() if codec._encode_piece(raw) != [t]]
    assert not wrong


def test_decoding_cut_characters(codec, library):
    ids = _ids(codec, "漢字\U0001f600")
    for cut in (ids[:-1], ids[1:], ids[:1]):
        assert codec.decode(np.array(cut, "<u4").tobytes()) == library.decode(cut, skip_special_tokens=False)


def test_tables(docs_of, edge_rows, library):
    got = bpe.round_trip_digests(docs_of(edge_rows), TOKENIZER).collect()
    expected = []
    for doc_id, text in edge_rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        digests = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()
        expected.append((doc_id, len(ids), *digests))
    assert collections.Counter(map(tuple, got)) == collections.Counter(expected)
    assert bpe.round_trip_digests(docs_of([]), TOKENIZER).collect() == []


def test_encode_then_decode(docs_of):
    rows = [(1, "some words, é"), (2, None)]
    encoded = bpe.encode_documents(docs_of(rows), TOKENIZER)
    assert {r.doc_id: r.text for r in bpe.decode_documents(encoded, TOKENIZER).collect()} == {1: "some words, é", 2: ""}
