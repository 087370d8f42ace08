"""Encoding against the library on whole texts, decoding by round trips."""

import base64
import random

import public_tokenizers
import pytest
import tiktoken
from matchmill.llm import bpe
from matchmill.llm.queries import vocabulary
from tests.llm.helpers import empty, odd

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def coder():
    return bpe.Coder(open(RANKS, "rb").read(), public_tokenizers.PATTERN)


@pytest.mark.parametrize("limit", [1, 7, 64])
def test_cuts_do_not_change_ids(coder, library, monkeypatch, limit):
    monkeypatch.setattr(bpe, "LONG_TEXT", limit)
    draw = random.Random(limit)
    pieces = ["the ", "don't", " we'll", "A1b2", "  ", "\n", "\n\n", " \t", "é", "日本", "12345", "...", "'", "'s", " 's", "　", "\x1c", "\U0001f600", "<|endoftext|>"]
    for _ in range(300):
        text = "".join(draw.choice(pieces) for _ in range(draw.randrange(60)))
        assert coder.encode(text).tolist() == library.encode_ordinary(text)
        assert coder.decode(coder.encode(text)) == text.encode()


def test_very_long_runs(coder):
    for text in (" " * 2_000_000 + "x", "a" * 300_000, "é" * 200_000):
        assert coder.decode(coder.encode(text)) == text.encode()


def test_unknown_ids_decode_to_null(coder):
    assert coder.decode([10**6]) is None
    assert coder.decode([None]) is None
    assert coder.decode([]) == b""


def test_table(spark, library):
    rows = bpe.encode_documents(odd(spark), vocabulary(spark)).collect()
    texts = sorted((r["text"] or "") for r in odd(spark).collect())
    assert sorted(bytes(r.decoded).decode() for r in rows) == texts
    assert sorted(map(len, (r.token_ids for r in rows))) == sorted(len(library.encode_ordinary(t)) for t in texts)
    assert bpe.digests(bpe.encode_documents(empty(spark), vocabulary(spark))).count() == 0
