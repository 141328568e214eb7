"""Current state as a bucketed append log: only a batch is exchanged."""

from keyedlake.plans import catalog as C

SF = "/root/testdata/sf0.001"


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


def test_stored_rows_are_not_exchanged(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = C._relational_state(spark, SF, range(3))
        assert exchanges(kept.state()) == 0
        before = sorted(map(tuple, kept.state().select(*C.REL_OUT).collect()), key=str)
        rows = kept.log().count()
        kept.fold()
        assert exchanges(kept.state()) == 0 and kept.log().count() == len(before) < rows
        assert sorted(map(tuple, kept.state().select(*C.REL_OUT).collect()), key=str) == before
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_replayed_batch_changes_nothing(spark):
    once, twice = C._relational_state(spark, SF, [0, 1]), C._relational_state(spark, SF, [0, 1, 1, 0])
    rows = lambda t: sorted(map(tuple, t.state().select(*C.REL_OUT).collect()), key=str)
    assert rows(once) == rows(twice)


def test_files_hold_one_bucket_each(spark):
    kept = C._relational_state(spark, SF, [0])
    files = kept.log().selectExpr("_metadata.file_name AS f", f"pmod(hash(parcel_id), {kept.buckets}) AS b").distinct().collect()
    assert len(files) == len({r.b for r in files}) == len({r.f for r in files})
