"""Phrases of the cross-parsing against a plain longest-match parse."""

import random

import numpy as np

from keyedlake.llm import langid


def phrases(text, sample):
    """Ziv-Merhav: the fewest pieces that each occur in the sample, taken longest first (an unknown symbol is one)."""
    n = at = 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at:at + size + 1] in sample:
            size += 1
        n, at = n + 1, at + size
    return n


def test_phrases_match_a_plain_parse():
    rnd = random.Random(2)
    word = lambda: bytes(rnd.choice(b"abc ") for _ in range(rnd.randint(1, 6)))
    samples = {name: b"".join(word() for _ in range(60)) for name in ("x", "y", "z")}
    parser = langid.Parser(samples)
    texts = [b"".join(word() for _ in range(rnd.randint(1, 400))) + rnd.choice([b"", b"Q", b"\xc3\xa9 abc"]) for _ in range(60)]
    costs = parser.costs(texts)
    for i, text in enumerate(texts):
        blocks = [text[a:a + langid.BLOCK] for a in range(0, len(text), langid.BLOCK)]
        for k, name in enumerate(parser.languages):
            want = sum(phrases(b, samples[name]) for b in blocks) * np.log2(len(samples[name]) + 1) / len(text)
            assert abs(costs[i, k] - want) < 1e-9


def test_the_automaton_knows_every_substring_and_no_other():
    text = b"abracadabra abba"
    edges = langid.suffix_automaton(text)

    def known(s):
        state = 0
        for c in s:
            if c not in edges[state]:
                return False
            state = edges[state][c]
        return True

    rnd = random.Random(4)
    for _ in range(3000):
        s = bytes(rnd.choice(b"abrcd ") for _ in range(rnd.randint(1, 6)))
        assert known(s) == (s in text)
