"""Weights of the quality model against plain loops."""

import random

import numpy as np
import pyarrow as pa

from keyedlake.llm import quality


def test_evidence_matches_plain_loops():
    rnd = np.random.default_rng(3)
    values = np.minimum(rnd.normal(0, 1, 5000), 0)
    begin, end = np.array([0, 10, 10, 400, 4999]), np.array([10, 10, 400, 4990, 5000])
    got = quality._evidence(values, begin, end)
    for row, (a, b) in enumerate(zip(begin, end)):
        own = values[a:b]
        assert np.isclose(got[0, row], own.mean() if b > a else 0)
        for k, width in enumerate(quality.WINDOWS, 1):
            want = min((own[i:i + width].sum() for i in range(len(own))), default=0)
            assert np.isclose(got[k, row], want)


def test_ngrams_stay_within_their_text():
    rnd = random.Random(1)
    texts = ["", "ab", "abcdefgh", "".join(rnd.choice("xyz \n") for _ in range(300)), "é" * 9]
    batch = pa.record_batch([pa.array(texts)], names=["text"])
    for buckets, begin, end in quality._ngrams(batch):
        for text, a, b in zip(texts, begin, end):
            alone = list(quality._ngrams(pa.record_batch([pa.array([text])], names=["text"])))
            assert any(np.array_equal(x[s[0]:e[0]], buckets[a:b]) for x, s, e in alone)
