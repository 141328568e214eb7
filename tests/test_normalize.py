import datetime as dt
from decimal import Decimal

from keyedlake.functions import normalize as N


def test_event_time_rules(spark):
    cases = {
        "2024-01-15T09:00:00": dt.datetime(2024, 1, 15, 9),
        "2024-01-15 09:00:00": dt.datetime(2024, 1, 15, 9),
        "2024-01-15T09:00:00.250": dt.datetime(2024, 1, 15, 9, 0, 0, 250000),
        "2024-1-5T09:00:00": dt.datetime(2024, 1, 5, 9),
        "": None, "   ": None, "2024-01-15": None, "2024-01-15T09:00": None,
        "2024-01-15T09:00:00Z": None, "2024-01-15T09:00:00+08:00": None,
        "2024-02-31T09:00:00": None, "junk": None, None: None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    got = {r.s: r.t for r in df.select("s", N.norm_event_time("s").alias("t")).collect()}
    assert got == cases


def test_relational_defaults_and_reject(spark):
    df = spark.createDataFrame(
        [("P1", None, "2024-01-15T09:00:00", "A"),
         ("P2", 1e20, "bad", "A"),
         ("P3", 12.345, None, "x" * 101),
         (None, 1.0, None, "A")],
        "parcelId string, transactionAmount double, transactionDate string, area string")
    rel = N.to_relational(df)
    assert "kafka_offset" in rel.columns and "title_deed_uri" in rel.columns
    rows = {r.parcel_id: r for r in N.conform_to_table(rel).collect()}
    assert rows["P1"].transaction_amount == Decimal("0.00") and rows["P1"]._reject_reason is None
    assert rows["P1"].kafka_partition == 0 and rows["P1"].kafka_offset == 0
    assert rows["P1"].transaction_date == dt.datetime(2024, 1, 15, 9)
    assert rows["P2"]._reject_reason == "transaction_amount out of range"
    assert rows["P2"].transaction_date is None
    assert rows["P3"].transaction_amount == Decimal("12.35")  # HALF_UP at the table's scale
    assert rows["P3"]._reject_reason == "area longer than 100"
    assert rows[None]._reject_reason == "parcel_id is null"
    valid, rejected = N.split_valid_rejected(N.conform_to_table(rel))
    assert valid.count() == 1 and rejected.count() == 3


def test_uri_and_file_class(spark):
    df = spark.createDataFrame([("PCL-1", "deed.parquet", 2048), ("PCL-1", ".abc.log.1", 10), ("P", "x.crc", 1)],
                               "p string, f string, n long")
    rows = df.select(N.document_uri("hdfs://nn/files", "p", "f").alias("u"),
                     N.file_class("f").alias("c"), N.size_kb("n").alias("kb")).collect()
    assert rows[0].u == "hdfs://nn/files/pdfs/titles/PCL-1/deed.parquet"
    assert [r.c for r in rows] == ["PARQUET", "LOG", "OTHER"]
    assert [r.kb for r in rows] == [2, 0, 0]
