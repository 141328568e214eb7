"""What streaming queries did, as a table: progress of each batch, late rows dropped, terminations.

``ProgressLog`` listens to all queries of a session.  It holds the events of the last ``keep``
batches; :meth:`flush` appends what it holds to a Parquet folder, for logs that go on for months.
"""

from __future__ import annotations

import threading
import time
from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener

SCHEMA = ("query_id string, run_id string, name string, event string, at string, batch_id bigint, input_rows bigint, "
          "dropped_late bigint, state_rows bigint, watermark string, error string")


class ProgressLog(StreamingQueryListener):
    def __init__(self, spark: SparkSession, keep: int = 10_000):
        self.spark, self._rows, self._lock = spark, deque(maxlen=keep), threading.Lock()
        self._ended: set[str] = set()

    def __enter__(self) -> "ProgressLog":
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *error) -> None:
        self.spark.streams.removeListener(self)

    def _add(self, *row) -> None:
        with self._lock:
            self._rows.append(row)

    def onQueryStarted(self, event) -> None:
        self._add(str(event.id), str(event.runId), event.name, "started", event.timestamp, *[None] * 6)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self._add(str(p.id), str(p.runId), p.name, "progress", p.timestamp, p.batchId, p.numInputRows,
                  sum(s.numRowsDroppedByWatermark for s in p.stateOperators),
                  sum(s.numRowsTotal for s in p.stateOperators), (p.eventTime or {}).get("watermark"), None)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._add(str(event.id), str(event.runId), None, "terminated", None, *[None] * 5, event.exception)
        self._ended.add(str(event.runId))

    def wait(self, run_id, timeout_s: float = 30) -> None:
        """Events come later than the query: until its termination is here."""
        end = time.monotonic() + timeout_s
        while str(run_id) not in self._ended:
            if time.monotonic() > end:
                raise TimeoutError(f"no termination of run {run_id} within {timeout_s}s")
            time.sleep(0.05)

    def table(self) -> DataFrame:
        with self._lock:
            return self.spark.createDataFrame(list(self._rows), SCHEMA)

    def flush(self, path: str) -> None:
        """Append the events held to ``path`` and forget them."""
        with self._lock:
            rows = list(self._rows)
            self._rows.clear()
        if rows:
            self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
