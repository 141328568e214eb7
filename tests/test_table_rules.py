"""Rows that a keyed table must not lose: odd partitions, commit order, replays, column types."""

import pytest
from pyspark.sql import functions as F

from keyedlake.plans import reports as REP
from keyedlake.sources import options as O
from keyedlake.sources.lake import LakeTable, path_exists
from keyedlake.streaming import sinks as SK

SCHEMA = "transactionId string, parcelId string, area string, transactionAmount double, transactionDate string"


def rows(spark, *values):
    return spark.createDataFrame([(t, p, a, x, "2024-01-01T00:00:00") for t, p, a, x in values], SCHEMA)


def amounts(df):
    return sorted((r.parcelId, r.area, r.transactionAmount) for r in df.collect())


@pytest.mark.parametrize("mode", ["dynamic", "static"])
def test_replay_of_the_latest_commit_replaces_it(spark, tmp_table, mode):
    t = LakeTable(spark, tmp_table("replay"), table_type="mor", buckets=2)
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        t.upsert(rows(spark, ("1", "a", "x", 1.0)), "001")
        t.upsert(rows(spark, ("2", "a", "x", 2.0), ("3", "b", "y", 666.0)), "002")
        t.upsert(rows(spark, ("2", "a", "x", 5.0)), "002")
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    assert amounts(t.snapshot()) == [("a", "x", 5.0)]
    with pytest.raises(ValueError, match="older"):
        t.upsert(rows(spark, ("9", "c", "x", 9.0)), "001")
    t.compact()
    with pytest.raises(ValueError, match="compacted"):
        t.upsert(rows(spark, ("2", "a", "x", 7.0)), "002")


def test_stream_after_batch_and_lost_checkpoint(spark, tmp_table):
    t = LakeTable(spark, tmp_table("order"), buckets=2)
    O.write(rows(spark, ("1", "a", "x", 1.0)), t.path)
    t = LakeTable.open(spark, t.path)
    sink = SK.lake_sink(t, stream="s1")
    sink(rows(spark, ("2", "a", "x", 2.0)), 0)
    assert amounts(t.snapshot()) == [("a", "x", 2.0)]
    sink(rows(spark, ("2", "a", "x", 3.0)), 0)  # a replay keeps its commit
    assert amounts(t.snapshot()) == [("a", "x", 3.0)] and len(t.commits()) == 2
    SK.lake_sink(t, stream="s2")(rows(spark, ("3", "a", "x", 4.0)), 0)  # a new checkpoint begins at 0 again
    sink(rows(spark, ("2", "a", "x", 9.0)), 0)  # an old replay comes too late to undo it
    assert amounts(t.snapshot()) == [("a", "x", 4.0)] and len(t.commits()) == 3


def test_overwrite_from_own_snapshot(spark, tmp_table):
    t = LakeTable(spark, tmp_table("self"), buckets=2)
    t.upsert(rows(spark, ("1", "a", "x", 1.0), ("2", "b", None, 2.0)), "001")
    t.overwrite(t.snapshot().filter("parcelId = 'b'"), "002")
    assert amounts(t.snapshot()) == [("b", None, 2.0)] and t.commits() == ["002"]
    with pytest.raises(ValueError, match="empty"):
        t.overwrite(t.snapshot().filter("1 = 0"), "003")
    assert amounts(t.snapshot()) == [("b", None, 2.0)]


def test_columns_and_types_are_kept_or_refused(spark, tmp_table):
    t = LakeTable(spark, tmp_table("types"), keys=("year", "parcelId"), partition="year", buckets=2)
    batch = rows(spark, ("1", "a", "x", 1.0)).withColumns({"_note": F.lit("n"), "year": F.lit(2024), "n": F.lit(1)})
    t.upsert(batch, "001")
    got = t.snapshot().select("_note", "year", "n").first()
    assert tuple(got) == ("n", 2024, 1) and dict(t.snapshot().dtypes)["year"] == "int"
    with pytest.raises(TypeError, match="lose"):
        t.upsert(batch.withColumn("n", F.lit(2.7)), "002")
    with pytest.raises(ValueError, match="_bucket"):
        t.upsert(batch.withColumn("_bucket", F.lit(1)), "002")
    t.upsert(batch.withColumn("n", F.lit(3).cast("smallint")), "002")
    assert t.snapshot().first().n == 3


def test_options_for_any_table(spark, tmp_table):
    path = tmp_table("smoke")
    df = spark.createDataFrame([("PURCHASE", "p1", 10.0), ("MORTGAGE", "p1", 5.0), ("PURCHASE", "p1", 12.0)],
                               "transactionType string, parcelId string, transactionAmount double")
    keys = {"recordkey.field": "parcelId", "partitionpath.field": "transactionType",
            "precombine.field": "transactionAmount"}
    O.write(df, path, mode="overwrite", **keys)
    assert sorted(r.transactionAmount for r in O.read(spark, path).collect()) == [5.0, 12.0]
    for bad in ({"parquet.max.file.size": "1"}, {"operation": "insert"}):
        with pytest.raises(ValueError):
            O.write(df, path, **keys, **bad)
    with pytest.raises(ValueError, match="unknown"):
        O.read(spark, path, **{"as.of": "1"})


def test_area_names_that_are_no_directory_names(spark, tmp_table):
    areas = [None, "", "null", "n", "v.", "a/b", "50%*", "é ~7E", "x=y"]
    for kind in ("cow", "mor"):
        t = LakeTable(spark, tmp_table(f"odd-{kind}"), table_type=kind, buckets=2)
        for commit, x in (("001", 1.0), ("002", 2.0)):
            t.upsert(rows(spark, *[("1", "p", a, x) for a in areas]), commit)
        assert sorted((r.area is None, r.area or "", r.transactionAmount) for r in t.snapshot().collect()) == sorted(
            (a is None, a or "", 2.0) for a in areas)
        assert t.snapshot().filter("area = ''").count() == 1


def test_clean_with_purge_frees_files(spark, tmp_table):
    t = LakeTable(spark, tmp_table("purge"), buckets=1)
    for k in range(4):
        t.upsert(rows(spark, ("1", "a", "x", float(k))), f"00{k}")
    slots = lambda: t.storage().filter("path like '%/data/%'").count()
    assert slots() == 4
    t.clean(2, purge=True)
    assert slots() == 3 and amounts(t.snapshot()) == [("a", "x", 3.0)]
    assert amounts(t.snapshot("002")) == [("a", "x", 2.0)]


def test_upsert_plan_shuffles_current_rows_once(spark, tmp_table):
    t = LakeTable(spark, tmp_table("plan"), buckets=2)
    both = t._with_group(rows(spark, ("1", "a", "x", 1.0)).withColumn("_commit_time", F.lit("001")))
    plan = t._reduced(both.unionByName(both))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_rejected_rows_are_kept_or_fail(spark, tmp_table):
    kw = dict(table_type="mor", keys=("parcel_id",), partition=None, record_key=("parcel_id",),
              precombine=("kafka_offset",), tie=(), buckets=2)
    batch = rows(spark, ("1", "a", "x", 1.0), ("2", "b" * 999, "x", 2.0))
    with pytest.raises(ValueError, match="do not fit"):
        SK.relational_sink(LakeTable(spark, tmp_table("strict"), **kw))(batch, 0)
    t, rejected, reports = LakeTable(spark, tmp_table("kept"), **kw), tmp_table("rejected"), tmp_table("reports")
    for _ in range(2):  # the replay adds nothing
        SK.relational_sink(t, rejected_path=rejected, report_path=reports)(batch, 0)
    assert t.snapshot().count() == 1 and spark.read.parquet(rejected).count() == 1
    assert spark.read.parquet(reports).select("rows_in", "rows_written", "rows_rejected").collect() == [(2, 1, 1)]
    assert not path_exists(spark, f"{t.path}.new")


def test_averages_of_null_and_huge_amounts(spark):
    df = spark.createDataFrame([("x", 10.0), ("x", None), ("z", None)] + [("y", 9e15)] * 200,
                               "area string, transactionAmount double")
    want = [("y", 200, 9e15, 9e15), ("x", 2, 10.0, 10.0), ("z", 1, None, None)]
    assert list(map(tuple, REP.area_breakdown(df).collect())) == want
    assert list(map(tuple, REP.sql_report(df, "area_breakdown").collect())) == want
