"""Driver tables seen as property transactions.

* TXE  ``events`` as transactions: key ``(event_type, user_id)`` as
       ``(area, parcelId)``, commit ``lpad(event_id % 5, 3, '0')`` (arrival
       order differs from event order, so late arrivals exist).
* TXO  ``orders ⋈ customer ⋈ nation``: ``parcelId = o_custkey``, ``area =
       n_name``, commit = year of ``o_orderdate``.
* ENV  TXE packed in the Kafka envelope; every 10th message has no parcelId.

All frames are derived by Spark from the given parquet tables, so their
work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import COMMIT_TIME, TRANSACTION_COLUMNS

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"
TXE_COMMITS = ["000", "001", "002", "003", "004"]
TXN_OUT = [*TRANSACTION_COLUMNS, "kafka_partition", "kafka_offset", COMMIT_TIME]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _null() -> F.Column:
    return F.lit(None).cast("string")


def events_as_transactions(ev: DataFrame) -> DataFrame:
    """events rows -> transaction rows (+ envelope position and commit)."""
    return ev.select(
        F.col("event_id").cast("string").alias("transactionId"),
        F.col("user_id").cast("string").alias("parcelId"),
        _null().alias("transactionType"),
        _null().alias("propertyType"),
        F.col("event_type").alias("area"),
        _null().alias("city"),
        _null().alias("buyerName"),
        _null().alias("sellerName"),
        F.col("value").alias("transactionAmount"),
        F.lit("PHP").alias("currency"),
        _null().alias("titleDeedUri"),
        _null().alias("status"),
        _null().alias("validationStatus"),
        F.date_format("ts", ISO_SECONDS).alias("transactionDate"),
        F.lit(0).cast("int").alias("kafka_partition"),
        F.col("event_id").alias("kafka_offset"),
        F.lpad((F.col("event_id") % 5).cast("string"), 3, "0").alias(COMMIT_TIME),
    )


def txe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_transactions(table(spark, sf_dir, "events"))


def txe_null_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TXE whose area is null for every 7th event and empty for every 11th."""
    n = F.col("kafka_offset")
    return txe(spark, sf_dir).withColumn(
        "area", F.when(n % 7 == 0, _null()).when(n % 11 == 0, F.lit("")).otherwise(F.col("area")))


def txo_null_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TXO whose amount is null for every 7th order."""
    return txo(spark, sf_dir).withColumn(
        "transactionAmount", F.when(F.col("kafka_offset") % 7 != 0, F.col("transactionAmount")))


def txo(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    # nation is the fixed 25-row TPC-H dimension: safe to broadcast
    n = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    j = (o.join(c, o.o_custkey == c.c_custkey)
          .join(n, F.col("c_nationkey") == F.col("n_nationkey")))
    return j.select(
        F.col("o_orderkey").cast("string").alias("transactionId"),
        F.col("o_custkey").cast("string").alias("parcelId"),
        F.col("o_orderpriority").alias("transactionType"),
        _null().alias("propertyType"),
        F.col("n_name").alias("area"),
        _null().alias("city"),
        _null().alias("buyerName"),
        _null().alias("sellerName"),
        F.col("o_totalprice").alias("transactionAmount"),
        F.lit("PHP").alias("currency"),
        _null().alias("titleDeedUri"),
        F.col("o_orderstatus").alias("status"),
        _null().alias("validationStatus"),
        F.date_format("o_orderdate", ISO_SECONDS).alias("transactionDate"),
        F.lit(0).cast("int").alias("kafka_partition"),
        F.col("o_orderkey").alias("kafka_offset"),
        F.year("o_orderdate").cast("string").alias(COMMIT_TIME),
    )


def envelope_from_events(ev: DataFrame) -> DataFrame:
    """ENV: TXE as Kafka messages; every 10th message carries no parcelId."""
    t = ev.select(
        "event_id", "ts", "user_id",
        F.struct(*[c.alias(n) for c, n in zip(_txe_field_exprs(), TRANSACTION_COLUMNS)]).alias("txn"),
    )
    return t.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.to_json("txn").cast("binary").alias("value"),
        F.lit("transactions").alias("topic"),
        F.lit(0).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def _txe_field_exprs() -> list[F.Column]:
    return [
        F.col("event_id").cast("string"),
        F.when(F.col("event_id") % 10 == 0, _null()).otherwise(F.col("user_id").cast("string")),
        _null(), _null(),
        F.col("event_type"),
        _null(), _null(), _null(),
        F.col("value"),
        F.lit("PHP"),
        _null(), _null(), _null(),
        F.date_format("ts", ISO_SECONDS),
    ]


def env(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope_from_events(table(spark, sf_dir, "events"))


def env_with_bad_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ENV whose value is cut off in every 13th message, no object in every 17th and null in every 19th."""
    n = F.col("offset")
    text = F.col("value").cast("string")
    bad = (F.when(n % 13 == 0, F.expr("substr(CAST(value AS STRING), 1, 20)"))
           .when(n % 17 == 0, F.concat(F.lit("not json "), n.cast("string")))
           .when(n % 19 == 0, F.lit(None).cast("string")).otherwise(text))
    return env(spark, sf_dir).withColumn("value", bad.cast("binary"))
