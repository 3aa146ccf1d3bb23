"""Byte-pair encoding against the tokenizer library, and the monoid's laws."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from odd import no_documents, odd_documents, odd_rows

from tabstudy.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def own():
    return bpe.codec(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(PATH), special_tokens={}
    )


@settings(max_examples=300, deadline=None)
@given(text=st.text(max_size=300))
def test_any_text(own, library, text):
    ids = own.encode(text)
    assert ids == library.encode_ordinary(text)
    assert own.decode(ids, leaf=2) == text.encode()


@settings(max_examples=300, deadline=None)
@given(text=st.text(alphabet="abethinrsou", min_size=1, max_size=400))
def test_long_pieces_join_to_the_direct_encoding(own, text):
    data = text.encode()
    assert own.encode_piece(data) == own.encode_leaf(data)


@settings(max_examples=200, deadline=None)
@given(parts=st.lists(st.binary(min_size=1, max_size=40), min_size=3, max_size=3))
def test_join_is_associative(own, parts):
    a, b, c = (own.encode_leaf(p) for p in parts)
    left, right = own.join(own.join(a, b), c), own.join(a, own.join(b, c))
    assert left == right == own.encode_leaf(b"".join(parts))


def test_very_long_piece(own, library):
    for text in ("a" * 20_000, "abc" * 7000, "é" * 5000, " " * 9000, "!?" * 4000):
        assert own.encode(text) == library.encode_ordinary(text)


def test_every_token_encodes_to_itself(own):
    for rank in range(0, len(own.tokens), 7):
        assert own.encode_piece(own.tokens[rank]) == [rank]


def test_odd_documents(spark, library):
    result = bpe.encode_documents(odd_documents(spark), PATH, public_tokenizers.PATTERN)
    got = sorted((str(r["doc_id"]), r["n_tokens"], list(r["ids"]), r["ids_sha256"], r["decoded_sha256"]) for r in result.collect())
    want = []
    for doc_id, text, *_ in odd_rows():
        ids = library.encode_ordinary(text or "")
        packed = np.array(ids, dtype="<u4").tobytes()
        want.append(
            (str(doc_id), len(ids), ids, hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
        )
    assert got == sorted(want)


def test_empty_table(spark):
    assert bpe.encode_documents(no_documents(spark), PATH, public_tokenizers.PATTERN).collect() == []
