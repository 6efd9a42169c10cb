import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from recordloom.llm import bpe
from tests.llm import cases


@pytest.fixture(scope="module")
def codec():
    return bpe._codec(None, None)


@pytest.fixture(scope="module")
def other(codec):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_any_text(codec, other, text):
    ids = codec.encode(text)
    assert ids == other.encode_ordinary(text) and codec.decode(ids) == text.encode()


def test_every_character_below_the_latin_bound(codec, other):
    for k in range(0x250):
        for t in (chr(k), f"a{chr(k)}b", f" {chr(k)}{chr(k)} 1{chr(k)}", f"'s{chr(k)} \n{chr(k)}"):
            assert codec.encode(t) == other.encode_ordinary(t), hex(k)


@pytest.mark.parametrize("piece", ["a" * 40_000, "ab" * 20_000, "%" * 30_000, " " * 20_000, "é" * 9_000])
def test_long_pieces(codec, other, piece):
    assert codec.encode(piece) == other.encode_ordinary(piece)


def test_random_piece(codec, other):
    rng = random.Random(2)
    t = "".join(rng.choice("abcdefghij") for _ in range(60_000))
    assert codec.encode(t) == other.encode_ordinary(t)


def test_cases(spark, codec):
    got = sorted((tuple(r) for r in bpe.digests(cases.documents(spark)).collect()), key=str)
    def wanted(i, t):
        ids = codec.encode(t)
        return i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()
    assert got == sorted((wanted(r[0], r[1]) for r in cases.rows()), key=str)
    assert bpe.digests(cases.nothing(spark)).count() == 0


def test_round_trip_of_frames(spark):
    df = cases.documents(spark)
    back = bpe.decode(bpe.encode(df)).collect()
    assert sorted((bytes(r["bytes"]) for r in back)) == sorted((r[1] or "").encode() for r in cases.rows())
