"""The corpus pipeline against brute force, stage by stage, and on odd rows."""

import re

import pytest
from pyspark.sql import functions as F
from test_operators import EXTRA, ODD, SF, _exact_expected, _hits_expected, _near_expected, _tiktoken

import corpus_pipeline
from keyedlake.llm.common import staged, table
from keyedlake.llm.quality import classify


def test_stages_are_the_dealt_ones():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact", "near", "decontaminate", "tokens"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_run_equals_brute_force(spark):
    docs = table(spark, SF, "documents")
    accepted = {r.doc_id for r in classify(docs, table(spark, SF, "labels")).filter("accepted").collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in accepted]
    kept = {r[0] for r in _exact_expected(rows) if r[3]}
    rows = [r for r in rows if r[0] in kept]
    kept = {r[0] for r in _near_expected(rows, 5) if r[3]}
    rows = [r for r in rows if r[0] in kept]
    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    kept = {r[0] for r in _hits_expected(rows, items) if not r[2]}
    encoder = _tiktoken()
    want = sorted((d, encoder.encode_ordinary(t), True) for d, t in rows if d in kept)
    got = corpus_pipeline.run(spark, SF).select("doc_id", "ids", "round_trip").collect()
    assert sorted(map(tuple, got)) == want
    assert 0 < len(want) < docs.count()


@pytest.mark.parametrize("empty", [False, True])
def test_stages_on_odd_rows(spark, empty):
    docs = spark.createDataFrame(ODD, "doc_id long, text string")
    docs = docs.withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long"),
                             **{c: F.lit("x") for c in EXTRA}})
    docs = docs.filter("1 = 0") if empty else docs
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, SF), f"test-{name}")
        assert docs.columns == columns or name == "tokens"
    texts = {re.sub(r"\s", "", (t or "").lower()) for _, t in ODD}
    assert docs.filter("not round_trip").count() == 0
    assert docs.count() == 0 if empty else 0 < docs.count() <= len(texts) + 2
