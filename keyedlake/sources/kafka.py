"""Kafka source and sink (needs the spark-sql-kafka connector on the classpath)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from ..functions.parse import encode_messages
from ..schema import RECORD_KEY


def kafka_available(spark: SparkSession) -> bool:
    """True when the Kafka data source can be resolved by this session."""
    try:
        spark.sparkContext._jvm.java.lang.Class.forName(
            "org.apache.spark.sql.kafka010.KafkaSourceProvider")
        return True
    except Exception:  # noqa: BLE001 - py4j wraps ClassNotFoundException
        return False


def kafka_source(spark: SparkSession, servers: str, topic: str, starting: str = "earliest",
                 fail_on_data_loss: bool = False, **options) -> DataFrame:
    """Subscribe one topic; the frame has the fixed envelope columns
    ``key, value, topic, partition, offset, timestamp``.  On restart the
    checkpoint's offsets win over ``startingOffsets``."""
    if not kafka_available(spark):
        raise RuntimeError("the spark-sql-kafka connector is not on the classpath "
                           "(add it with --packages or spark.jars)")
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic)
         .option("startingOffsets", starting)
         .option("failOnDataLoss", str(fail_on_data_loss).lower()))
    for k, v in options.items():
        r = r.option(k, str(v))
    return r.load()


def kafka_sink(df: DataFrame, servers: str, topic: str, checkpoint: str,
               key: str = RECORD_KEY) -> DataStreamWriter:
    """Write rows back to a topic as JSON values keyed by ``key``."""
    return (encode_messages(df, key).writeStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("topic", topic)
            .option("checkpointLocation", checkpoint))
