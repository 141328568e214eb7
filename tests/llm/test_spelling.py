"""Spelling variants against all pairs of words, and on odd texts."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from keyedlake.llm import queries, spelling
from keyedlake.llm.common import table
from keyedlake.llm.spelling import _codes, _one_edit, _vectors, grow, spelling_variants, visit

SF = "/root/testdata/sf0.001"


def near(a, b):
    """One inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                n[run] += 1
    n = {w: c for w, c in n.items() if c >= 2}
    forms, counts = {}, {}
    for w in n:
        own = [x for x in n if abs(len(x) - len(w)) <= 1 and near(w, x)]
        best = min(own, key=lambda x: (-n[x], x), default=None)
        counts[w] = len(own)
        forms[w] = best if best is not None and n[best] >= 10 * n[w] else None

    def root(w):
        while forms[w] is not None:
            w = forms[w]
        return w

    return sorted((w, forms[w] or "", root(w), n[w], counts[w], n[forms[w]] if forms[w] else 0) for w in n)


def rows_of(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in df.collect())


@pytest.fixture(scope="module")
def given(spark):
    return plain([(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()])


def test_given_words(spark, given):
    assert rows_of(queries.op11_spelling(spark, SF)) == given


def test_many_cells_give_the_same(spark, given, monkeypatch):
    monkeypatch.setattr(spelling, "CELL_LETTERS", 300)
    monkeypatch.setattr(spelling, "LEAF", 3)
    assert rows_of(queries.op11_spelling(spark, SF)) == given


def test_visits_miss_no_word_in_reach():
    rnd = random.Random(1)
    words = sorted({"".join(rnd.choice("abcdeé") for _ in range(7)) for _ in range(600)} | {"aaaaaaa", "ééééééé"})
    v = _vectors(_codes(words))
    apart = np.abs(v[:, None, :] - v[None, :, :]).sum(2)
    nodes = grow(v, 5)
    for radius in (1, 2):
        met = {(q, m) for _, members, asks, _ in visit(nodes, v, radius) for q in asks.tolist() for m in members.tolist()}
        assert all((q, m) in met for q, m in zip(*(x.tolist() for x in np.nonzero(apart <= radius))))
        assert len(met) < len(words) ** 2 / 2  # boxes are passed over


def test_letter_order():
    rnd = random.Random(2)
    for longer in (0, 1):
        a, b = (["".join(rnd.choice("ab") for _ in range(5 + x)) for _ in range(2000)] for x in (0, longer))
        assert _one_edit(_codes(a), _codes(b)).tolist() == [near(x, y) for x, y in zip(a, b)]


def test_odd_texts(spark):
    rnd = random.Random(4)
    base = ["".join(rnd.choice("abcdeàéÿ÷") for _ in range(9)) for _ in range(40)]
    noisy = []
    for w in base:
        for _ in range(6):
            i = rnd.randrange(len(w))
            noisy += [w[:i] + w[i + 1:], w[:i] + rnd.choice("xyz") + w[i:], w[:i] + rnd.choice("xyz") + w[i + 1:]]
    texts = [" ".join(base * 12), " ".join(noisy), " ".join(noisy), None, "", " \t\n", "short words only", "日本語 " * 50,
             "ABCDEFGHIJ abcdefghij ABCDEFGHIX ÀBCDEFGHI àBCDEFGHI", "abcdefghij " * 500, "q" * 20_000 + " " + "q" * 20_001,
             "q" * 20_000 + " " + "q" * 20_001, " ".join("".join(rnd.sample("abcdefg", 7)) for _ in range(3000))]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "nullnull nullnull nullnulls nullnulls"), (5, texts[0]), (5, texts[0])]
    clash = {c: F.lit("x") for c in ("word", "n", "cell", "query", "best", "form", "root", "n_near")}
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).withColumns(clash)
    got = rows_of(spelling_variants(df))
    assert got == plain(rows) and any(r[1] for r in got)
    assert rows_of(spelling_variants(df.filter("1 = 0"))) == []


def test_chains_of_forms(spark):
    text = " ".join(["chainaaa"] * 2000 + ["chainaab"] * 150 + ["chainabb"] * 12 + ["chainbbb"])
    rows = [(i, text) for i in (1, 2)]
    got = {r[0]: r for r in rows_of(spelling_variants(spark.createDataFrame(rows, "doc_id long, text string")))}
    assert list(map(tuple, got.values())) == plain(rows)
    assert sum(r[1] != r[2] for r in got.values() if r[1]) >= 1  # some root is further than the form
