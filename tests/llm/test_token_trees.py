"""Stored trees: edit rounds from Parquet encode what the edits touch, and counts equal a full encode."""

import random

import pytest
import tiktoken
from pyspark.sql import functions as F

from keyedlake.llm import queries, token_counts
from keyedlake.llm.bpe import load_ranks
from keyedlake.llm.common import staged, table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokens_of():
    library = tiktoken.Encoding("x", pat_str=queries.PATTERN, mergeable_ranks=load_ranks(queries.RANKS), special_tokens={})
    return lambda text: len(library.encode_ordinary(text or ""))


def rounds(spark, rows, edit_rounds):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    trees = staged(token_counts.plant(df, queries.RANKS, queries.PATTERN), "trees")
    for edits in edit_rounds:
        table_ = spark.createDataFrame(edits, f"doc_id long, edits {token_counts.EDITS}")
        trees = staged(token_counts.update(trees, table_, queries.RANKS, queries.PATTERN), "trees")
        yield {r.doc_id: r for r in trees.collect()}


def test_two_rounds_of_edits(spark, tokens_of):
    rnd = random.Random(6)
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").filter(F.length("text") > 3000).collect()]
    texts = dict(rows)
    plans = []
    for _ in range(2):
        edits = []
        for doc_id in sorted(texts)[::2]:
            begin = rnd.randrange(len(texts[doc_id]))
            edits.append((doc_id, [(begin, begin + rnd.randint(0, 9), rnd.choice(["", " new words", "x", "\n\n12"]))]))
        plans.append(edits)
    for edits, got in zip(plans, rounds(spark, rows, plans)):
        for doc_id, [(begin, end, put)] in edits:
            texts[doc_id] = texts[doc_id][:begin] + put + texts[doc_id][end:]
        assert {d: r.text for d, r in got.items()} == texts
        assert all(r.n_tokens == tokens_of(r.text) == sum(r.tokens) and sum(r.sizes) == len(r.text) for r in got.values())
        edited = {d for d, _ in edits}
        assert all(r.reencoded_chars == 0 for d, r in got.items() if d not in edited)
        # leaves that the edit doesn't touch aren't encoded
        assert all(0 < got[d].reencoded_chars <= 6 * token_counts.LEAF_CHARS < len(texts[d]) for d in edited)


def test_odd_edits_of_stored_trees(spark, tokens_of):
    rows = [(1, None), (2, ""), (3, "some words here"), (None, "null id"), (4, "a" * 5000)]
    edits = [(1, [(5, 9, "now text")]), (2, []), (3, [(None, None, "b "), (4, 2, None)]), (None, [(0, 1, "x")]), (9, [(0, 0, "y")]),
             (4, [(0, 5000, "")]), (4, [(0, 0, "zz")])]
    got = next(rounds(spark, rows, [edits]))
    assert {d: r.text or "" for d, r in got.items() if d != 4} == {1: "now text", 2: "", 3: "b some words here", None: "null id"}
    assert all(r.n_tokens == tokens_of(r.text) for r in got.values()) and len(got) == 5
