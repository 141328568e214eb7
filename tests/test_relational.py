from pyspark.sql import functions as F

from keyedlake.operators import relational as R
from keyedlake.plans import fixtures as FX

S = "parcelId string, area string, transactionId string, transactionDate string, transactionAmount double, " \
    "kafka_partition int, kafka_offset long"


def test_last_arrival_wins_even_if_older(spark):
    b0 = R.prepare_batch(spark.createDataFrame(
        [("P1", "Makati", "t1", "2024-01-15T10:00:00", 1.0, 0, 1)], S), batch_id=0)
    b1 = R.prepare_batch(spark.createDataFrame(
        [("P1", "Taguig", "t2", "2024-01-01T00:00:00", 2.0, 0, 7),   # moved area, older event
         ("P2", "BGC", "t3", None, None, 0, 8),
         ("P2", "BGC", "t4", None, 5.0, 0, 9)], S), batch_id=1)
    cur = R.last_arrival(b0)
    cur = R.upsert_last_arrival(cur, b1)
    rows = {r.parcel_id: r for r in cur.collect()}
    assert len(rows) == 2  # one row per parcel even after an area change
    assert rows["P1"].area == "Taguig" and rows["P1"].transaction_id == "t2"
    assert rows["P2"].transaction_id == "t4"  # later offset in the batch wins


def test_batch_report(spark):
    t = FX.txe(spark, "/root/testdata/sf0.001").withColumn("_batch_id", (F.col("kafka_offset") % 5).cast("long"))
    rep = R.batch_report(R.prepare_batch(t, limits={"area": 5})).collect()
    assert sum(r.rows_in for r in rep) == 1000
    assert all(r.rows_in == r.rows_written + r.rows_rejected for r in rep)


def test_merge_statement_quotes_columns():
    sql = R.merge_statement("property_transactions", "stage")
    assert sql.startswith("MERGE INTO property_transactions t USING stage s ON t.\"parcel_id\" = s.\"parcel_id\"")
    assert "\"last_updated\" = CURRENT_TIMESTAMP" in sql and "WHEN NOT MATCHED THEN INSERT" in sql


def test_fold_equals_single_reduction(spark):
    from keyedlake.plans import catalog as C
    t = FX.txe(spark, "/root/testdata/sf0.001")
    current = None
    for i in range(5):
        b = t.filter(F.col("kafka_offset") % 5 == i).drop("_commit_time")
        valid, _ = R.valid_and_rejected(b, batch_id=i)
        current = R.last_arrival(valid) if current is None else R.upsert_last_arrival(current, valid)
    folded = sorted(map(tuple, current.select(*C.REL_OUT).collect()))
    assert folded == sorted(map(tuple, C.q_relational_upsert(spark, "/root/testdata/sf0.001").collect()))
