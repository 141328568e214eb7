"""Current state per key as a bucketed append log.

Each batch's last arrivals are appended to a table bucketed by the key, so only the batch is
exchanged; what is stored isn't read on a write.  The state is the latest row of each key: a
window over the buckets as they lie, with no exchange above the scan.  :meth:`fold` replaces
the log by the state, also without an exchange.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.relational import ARRIVAL_ORDER, last_arrival
from ..schema import RELATIONAL_KEY


class BucketedState:
    """The table ``name`` of the session's catalog, its files in folders below ``path``.

    A replayed batch appends rows equal in order to those it has appended before, of which one
    is kept.  ``buckets``: about (bytes of the state / 1 GB), fixed at the first batch.
    """

    def __init__(self, spark: SparkSession, name: str, path: str, key: str = RELATIONAL_KEY, buckets: int = 16,
                 order: Sequence[str] = ARRIVAL_ORDER):
        self.spark, self.name, self.path = spark, name, path.rstrip("/")
        self.key, self.buckets, self.order = key, buckets, list(order)

    def _write(self, rows: DataFrame, name: str, exists: bool = False) -> None:
        w = rows.write.format("parquet").mode("append").bucketBy(self.buckets, self.key).sortBy(self.key)
        if not exists:
            w = w.option("path", f"{self.path}/{uuid.uuid4().hex}")
        w.saveAsTable(name)

    def append(self, batch: DataFrame) -> None:
        """Rows of one batch, with the columns of ``order``."""
        rows = last_arrival(batch, self.key, self.order).repartition(self.buckets, self.key)
        exists = self.spark.catalog.tableExists(self.name)
        if exists:
            rows = rows.select(*self.spark.table(self.name).columns)
        self._write(rows, self.name, exists)

    def log(self) -> DataFrame:
        return self.spark.table(self.name)

    def state(self) -> DataFrame:
        return last_arrival(self.log(), self.key, self.order)

    def fold(self) -> None:
        """Keep the state alone.  It is written beside the log and takes its name once it is complete."""
        folded = f"{self.name}_{uuid.uuid4().hex[:8]}"
        self._write(self.state(), folded)
        self.spark.sql(f"DROP TABLE {self.name}")
        self.spark.sql(f"ALTER TABLE {folded} RENAME TO {self.name}")
