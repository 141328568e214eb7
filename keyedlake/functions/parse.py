"""Envelope decoding and JSON parsing (batch and stream alike)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import RECORD_KEY, TRANSACTION_COLUMNS, TRANSACTION_SCHEMA


def envelope_columns(df: DataFrame) -> DataFrame:
    """Expose the envelope under ``kafka_*`` names; key decoded to text."""
    return df.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("value"),
    )


def parse_json(text: Column, schema=TRANSACTION_SCHEMA) -> Column:
    """Typed, permissive JSON parse: bad text gives null fields, not errors."""
    return F.from_json(text, schema, {"mode": "PERMISSIVE"})


def parse_transactions(envelope: DataFrame, layout: str = "table",
                       require_key: bool | None = None) -> DataFrame:
    """Kafka envelope -> one typed column per transaction field.

    ``layout="table"`` (lake and relational pipelines): the 14 fields then
    ``kafka_partition, kafka_offset``; key-less rows are dropped.
    ``layout="console"``: ``kafka_key, kafka_partition, kafka_offset,
    kafka_timestamp`` first, then the fields; every message kept.
    """
    # One JSON parse per message: ``inline(array(struct))`` flattens the
    # parsed struct in a generator, which the key filter cannot be pushed
    # below (a plain select would let Catalyst copy from_json into the filter
    # and parse every message twice).  A message that does not parse gives
    # one row of nulls.
    fields = F.inline(F.array(parse_json(F.col("value").cast("string"))))
    if layout == "console":
        out = envelope.select(
            fields,
            F.col("key").cast("string").alias("kafka_key"),
            F.col("partition").alias("kafka_partition"),
            F.col("offset").alias("kafka_offset"),
            F.col("timestamp").alias("kafka_timestamp"),
        ).select("kafka_key", "kafka_partition", "kafka_offset", "kafka_timestamp", *TRANSACTION_COLUMNS)
        keep_all = True
    elif layout == "table":
        out = envelope.select(
            fields,
            F.col("partition").alias("kafka_partition"),
            F.col("offset").alias("kafka_offset"),
        ).select(*TRANSACTION_COLUMNS, "kafka_partition", "kafka_offset")
        keep_all = False
    else:
        raise ValueError(f"unknown layout {layout!r}")
    if require_key is None:
        require_key = not keep_all
    return out.filter(F.col(RECORD_KEY).isNotNull()) if require_key else out


_CORRUPT = "_corrupt"


def split_messages(envelope: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows for the table, messages set aside); each message is in exactly one of them.

    The rows are those of ``parse_transactions(layout="table")``.  A message is set aside with its raw
    value, key, position and a reason if it has no value, is no JSON object of the schema's types
    (a field of another type included), or carries no parcelId.
    """
    schema = T.StructType([*TRANSACTION_SCHEMA.fields, T.StructField(_CORRUPT, T.StringType())])
    parsed = F.from_json(F.col("value").cast("string"), schema,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    # one parse per message, see parse_transactions
    rows = envelope.select(F.inline(F.array(parsed)), F.col("value"), F.col("key"), F.col("partition").alias("kafka_partition"),
                           F.col("offset").alias("kafka_offset"), F.col("timestamp").alias("kafka_timestamp"))
    reason = (F.when(F.col("value").isNull(), "no value").when(F.col(_CORRUPT).isNotNull(), "not parsable")
              .when(F.col(RECORD_KEY).isNull(), f"no {RECORD_KEY}"))
    rows = rows.withColumn("reason", reason)
    kept = rows.filter(F.col("reason").isNull()).select(*TRANSACTION_COLUMNS, "kafka_partition", "kafka_offset")
    aside = rows.filter(F.col("reason").isNotNull()).select(
        F.col("key").cast("string").alias("kafka_key"), "kafka_partition", "kafka_offset", "kafka_timestamp",
        F.col("value").cast("string").alias("raw_value"), "reason")
    return kept, aside


def json_field(text: Column, name: str, ddl_type: str) -> Column:
    """One typed field out of a JSON object column."""
    return F.from_json(text, f"`{name}` {ddl_type}")[name]


def high_value(df: DataFrame, threshold: float = 1_000_000.0,
               column: str = "transactionAmount") -> DataFrame:
    """Threshold filter; pushed to the scan when the column is stored."""
    return df.filter(F.col(column) > F.lit(threshold))


def encode_messages(df: DataFrame, key: str = RECORD_KEY) -> DataFrame:
    """Rows -> Kafka sink shape: ``key``/``value`` as text (JSON value)."""
    return df.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"),
    )
