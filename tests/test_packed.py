"""Appends that top up underfull files."""

import pytest
from pyspark.sql import functions as F

from keyedlake.plans import fixtures as FX
from keyedlake.sources import packed as PK

SF = "/root/testdata/sf0.1"


def sizes(spark, path):
    return sorted(r.bytes for r in PK.live_files(spark, path).collect())


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_underfull_files_are_topped_up(spark, tmp_table):
    path, target, small = tmp_table("packed"), 400_000, 300_000
    txe = FX.txe(spark, SF).repartition(6)
    total, seen = [], []
    for k in range(6):
        batch = txe.filter(F.col("kafka_offset") % 6 == k)
        before = sizes(spark, path) if total else []
        PK.append_packed(batch, path, target=target, small=small)
        total.append(batch)
        after = sizes(spark, path)
        seen.append((before, after))
        # full files stay, all but one file are about full, none is far above the target
        assert [b for b in before if b >= small] == [b for b in before if b >= small and b in after]
        assert sum(b < small for b in after) <= 1 + len(after) // 4 and max(after) < 1.3 * target
    whole = total[0]
    for b in total[1:]:
        whole = whole.unionByName(b)
    assert rows(PK.read_packed(spark, path).select(*whole.columns)) == rows(whole)
    assert len(seen[-1][1]) < 6 * 6  # fewer files than were landed


def test_a_failed_append_leaves_nothing(spark, tmp_table):
    path = tmp_table("packed-fail")
    df = spark.range(100).select("id", (F.col("id") % 7).alias("v"))
    PK.append_packed(df, path)
    broken = df.select("id", F.when(F.col("id") == 50, F.raise_error(F.lit("stop")).cast("long")).otherwise(F.col("v")).alias("v"))
    with pytest.raises(Exception, match="stop"):
        PK.append_packed(broken, path)
    PK._write(df.withColumn("_file", F.lit("f0")), path, "dead-landed")  # died before it was listed
    assert rows(PK.read_packed(spark, path)) == rows(df)
    assert PK.append_packed(df.limit(0), path) is None
    PK.append_packed(df.withColumn("extra", F.lit("x")), path)  # a new column
    assert PK.read_packed(spark, path).filter("extra is null").count() == 100
    assert PK.vacuum(spark, path) >= 1 and PK.read_packed(spark, path).count() == 200


def test_reads_prune_replaced_files(spark, tmp_table):
    path = tmp_table("packed-plan")
    for k in range(3):
        PK.append_packed(spark.range(k * 100, k * 100 + 100).toDF("id"), path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "3000")
    plan = PK.read_packed(spark, path)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "dynamicpruning" in plan.split("PartitionFilters")[1]
    assert len(PK.live_files(spark, path).collect()) == 1
