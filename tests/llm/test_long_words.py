"""Single words of thousands of letters, against the tiktoken library."""

import random

import numpy as np
import pytest
import tiktoken

from keyedlake.llm import bpe, queries


@pytest.fixture(scope="module")
def both():
    ranks = bpe.load_ranks(queries.RANKS)
    library = tiktoken.Encoding("x", pat_str=queries.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return bpe.Codec(ranks, queries.PATTERN), lambda w: library._encode_single_piece(w)


@pytest.mark.parametrize("letters", ["abcdefghijklmnopqrstuvwxyz", "ACGT", "ab", "a", "éèñü", "日本語", "-="])
def test_words_of_any_length(both, letters):
    codec, library = both
    rnd = random.Random(len(letters))
    for size in (65, 130, 400, 3000):
        word = "".join(rnd.choice(letters) for _ in range(size))
        assert np.frombuffer(codec._encode_words([word.encode()])[0], "<u4").tolist() == library(word)


def test_words_of_repeated_parts(both):
    codec, library = both
    rnd = random.Random(11)
    words = ["".join(rnd.choice(["tion", "sch", "keit", "ing", "aa", "a", "bb"]) for _ in range(rnd.randint(20, 300))) for _ in range(30)]
    got = codec._encode_words([w.encode() for w in words])
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [library(w) for w in words]
