"""The three streaming entry points: envelope stream -> parse -> sink.

Each takes a streaming frame with the Kafka envelope columns (from
``sources.kafka.kafka_source`` in production, or a file stream of envelope
parquet) and returns the started query.  Triggers default to the reference
intervals; ``available_now=True`` drains what is there and stops.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..functions.parse import parse_transactions
from ..sources.lake import LakeTable
from . import runner as RUN
from . import sinks as SK


def table_ingest(envelope: DataFrame, table: LakeTable, checkpoint: str,
                 trigger: str = RUN.TRIGGER_TABLE, available_now: bool = False) -> StreamingQuery:
    """Parse, drop key-less messages, upsert each micro-batch into the lake table."""
    parsed = parse_transactions(envelope, layout="table")
    return RUN.start(parsed.writeStream.foreachBatch(SK.lake_sink(table, stream=checkpoint)), checkpoint,
                     trigger=trigger, available_now=available_now)


def relational_ingest(envelope: DataFrame, checkpoint: str, table: LakeTable | None = None,
                      jdbc_url: str | None = None, jdbc_table: str = "property_transactions",
                      jdbc_properties: Mapping[str, str] | None = None,
                      trigger: str = RUN.TRIGGER_RELATIONAL, available_now: bool = False,
                      rejected_path: str | None = None, report_path: str | None = None) -> StreamingQuery:
    """Parse, then keep the current state per parcel: a keyed parquet table
    (``table``) or a database table through staging + ``MERGE`` (``jdbc_url``).
    ``update`` mode, as the reference runs it (no aggregation: same as append)."""
    parsed = parse_transactions(envelope, layout="table")
    if (table is None) == (jdbc_url is None):
        raise ValueError("give exactly one of table= or jdbc_url=")
    kept = {"rejected_path": rejected_path, "report_path": report_path}
    body = (SK.relational_sink(table, **kept, stream=checkpoint) if table is not None
            else SK.jdbc_sink(jdbc_url, jdbc_table, jdbc_properties, **kept))
    return RUN.start(parsed.writeStream.foreachBatch(body), checkpoint, trigger=trigger,
                     available_now=available_now, output_mode="update")


def console_ingest(envelope: DataFrame, checkpoint: str, trigger: str = RUN.TRIGGER_CONSOLE,
                   available_now: bool = False, num_rows: int = 50) -> StreamingQuery:
    """Every message (key-less ones too) with its envelope position, printed."""
    parsed = parse_transactions(envelope, layout="console")
    return RUN.start(SK.console(parsed, num_rows), checkpoint, trigger=trigger,
                     available_now=available_now)
