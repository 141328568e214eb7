"""Stages judge rows, not ids."""

from pyspark.sql import functions as F

from keyedlake.llm.exact_dedup import drop_copies
from keyedlake.llm.near_dedup import drop_near_copies


def test_exact_copies_under_a_repeated_id(spark):
    rows = [(0, "aaaa "), (1, "aaaa"), (1, "bbbb"), (2, "b bbb"), (3, "cc"), (3, "c c"), (3, "cc"), (None, "dd"), (None, "dd")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("__keep_id", F.lit("x")).drop("__keep_id")
    got = drop_copies(df.repartition(3))
    assert got.columns == df.columns
    # of the b texts, the one with more code points stays
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(0, "aaaa "), (2, "b bbb"), (3, "c c"), (None, "dd")], key=str)


def test_near_copies_judge_each_text_of_an_id(spark):
    words = [f"w{i}" for i in range(60)]
    one, other = " ".join(words), " ".join(reversed(words))
    rows = [(0, one), (1, "x " + one), (2, other), (2, "some other words that are not like any of the rest here")]
    got = drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string"), width=5, threshold=80)
    assert sorted(map(tuple, got.collect())) == [rows[0], rows[2], rows[3]][:1] + sorted([rows[2], rows[3]])
