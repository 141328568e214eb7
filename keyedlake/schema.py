"""Schemas, column names and the relational column contract."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: field names of the JSON transaction message, in message order
TRANSACTION_FIELDS = [
    ("transactionId", "string"),
    ("parcelId", "string"),
    ("transactionType", "string"),
    ("propertyType", "string"),
    ("area", "string"),
    ("city", "string"),
    ("buyerName", "string"),
    ("sellerName", "string"),
    ("transactionAmount", "double"),
    ("currency", "string"),
    ("titleDeedUri", "string"),
    ("status", "string"),
    ("validationStatus", "string"),
    ("transactionDate", "string"),  # kept as text, parsed late
]

_TYPES = {"string": T.StringType(), "double": T.DoubleType()}

TRANSACTION_SCHEMA = T.StructType(
    [T.StructField(n, _TYPES[t], True) for n, t in TRANSACTION_FIELDS]
)
TRANSACTION_COLUMNS = [n for n, _ in TRANSACTION_FIELDS]

# Kafka message envelope (same in batch and stream).
ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType(), True),
        T.StructField("value", T.BinaryType(), True),
        T.StructField("topic", T.StringType(), True),
        T.StructField("partition", T.IntegerType(), True),
        T.StructField("offset", T.LongType(), True),
        T.StructField("timestamp", T.TimestampType(), True),
    ]
)

# Lake table defaults: record key, partition path, precombine (ordering) field.
RECORD_KEY = "parcelId"
PARTITION_FIELD = "area"
PRECOMBINE_FIELD = "transactionDate"
TIE_BREAK_FIELD = "transactionId"

# Metadata columns stored with every lake row.
COMMIT_TIME = "_commit_time"
COMMIT_SEQNO = "_commit_seqno"
RECORD_KEY_COL = "_record_key"
PARTITION_PATH = "_partition_path"
FILE_NAME = "_file_name"

# --- fixed values: relational target table (column, source field, type, max length)
# Order is the table's column order; last_updated is stamped at write time.
RELATIONAL_COLUMNS = [
    ("parcel_id", "parcelId", "varchar", 50),
    ("transaction_id", "transactionId", "varchar", 50),
    ("transaction_type", "transactionType", "varchar", 30),
    ("property_type", "propertyType", "varchar", 30),
    ("area", "area", "varchar", 100),
    ("city", "city", "varchar", 100),
    ("buyer_name", "buyerName", "varchar", 200),
    ("seller_name", "sellerName", "varchar", 200),
    ("transaction_amount", "transactionAmount", "numeric(15,2)", None),
    ("currency", "currency", "varchar", 10),
    ("title_deed_uri", "titleDeedUri", "varchar", 500),
    ("status", "status", "varchar", 30),
    ("validation_status", "validationStatus", "varchar", 30),
    ("transaction_date", "transactionDate", "timestamp", None),
    ("kafka_partition", "kafka_partition", "int", None),
    ("kafka_offset", "kafka_offset", "bigint", None),
]
RELATIONAL_KEY = "parcel_id"
AMOUNT_PRECISION, AMOUNT_SCALE = 15, 2

VARCHAR_LIMITS = {c: n for c, _, t, n in RELATIONAL_COLUMNS if t == "varchar"}
CAMEL_TO_SNAKE = {src: c for c, src, _, _ in RELATIONAL_COLUMNS}


def ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
