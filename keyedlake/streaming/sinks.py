"""Sinks: keyed lake table, relational table, console, parquet, JDBC."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from ..functions.normalize import conform_to_table, split_valid_rejected, to_relational
from ..operators.relational import jdbc_merge, prepare_batch
from ..session import scratch_path
from ..sources.lake import LakeTable, delete_path


def commit_id(batch_id: int, width: int = 20) -> str:
    """A commit id that is the zero-padded batch id, for tables that one stream alone writes."""
    return f"{batch_id:0{width}d}"


def _commit(table: LakeTable, batch_id: int, width: int | None, stream: str) -> tuple[str, str]:
    """The batch's commit and name.  A replayed batch keeps the commit it had; a new one gets
    the table's next commit, above whatever batch jobs wrote to the same table."""
    source = f"{stream}:{batch_id}"
    if width:
        return commit_id(batch_id, width), source
    return table.source_commit(source) or table.next_commit(), source


def _upsert(table: LakeTable, df: DataFrame, batch_id: int, width: int | None, stream: str,
            seen: Observation | None = None) -> bool:
    """False if the batch was written before and commits came after it."""
    commit, source = _commit(table, batch_id, width, stream)
    if table.source_commit(source) and commit < table.commits()[-1]:
        return False
    table.upsert(df, commit=commit, source=source, seen=seen)
    return True


def lake_sink(table: LakeTable, width: int | None = None,
              stream: str = "stream") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body: upsert the micro-batch as the table's next commit.

    ``stream`` names the stream (its checkpoint): a replayed batch of one name rewrites
    its own commit.  ``width`` makes the batch id itself the commit id instead.
    """
    def write(df: DataFrame, batch_id: int) -> None:
        if df.isEmpty():
            return
        _upsert(table, df, batch_id, width, stream)
    return write


def relational_rows(df: DataFrame, batch_id: int, limits: Mapping[str, int] | None = None):
    """Batch rows -> (valid, rejected) relational rows, stamped with the
    batch id (arrival order) and ``last_updated`` (processing time)."""
    rows = to_relational(df.withColumn("_batch_id", F.lit(batch_id).cast("long")))
    rows = rows.withColumn("last_updated", F.current_timestamp())
    return split_valid_rejected(conform_to_table(rows, limits))


@contextmanager
def _landed(prepared: DataFrame, batch_id: int, rejected_path: str | None) -> Iterator[tuple[DataFrame, dict[str, int]]]:
    """Compute the batch once: write it as Parquet, valid and rejected rows apart, and observe its
    counts while it is written.  Gives the valid rows as read back, and the counts; what was
    written goes when the batch is done.

    Rejected rows are kept at ``rejected_path`` or fail the batch; a replay overwrites them.
    """
    path = scratch_path(prepared.sparkSession, "landed")
    try:
        yield _split(prepared, batch_id, rejected_path, path)
    finally:
        delete_path(prepared.sparkSession, path)


def _split(prepared: DataFrame, batch_id: int, rejected_path: str | None, path: str) -> tuple[DataFrame, dict[str, int]]:
    spark, seen = prepared.sparkSession, Observation()
    ok = F.col("_reject_reason").isNull()
    (prepared.observe(seen, F.count(F.lit(1)).alias("rows_in"), F.count(F.when(ok, 1)).alias("rows_written"),
                      F.count(F.when(~ok, 1)).alias("rows_rejected"))
     .withColumn("_ok", ok.cast("int")).write.partitionBy("_ok").parquet(path))
    counts = seen.get
    landed = spark.read.schema(T.StructType([*prepared.schema.fields, T.StructField("_ok", T.IntegerType())])).parquet(path)
    if rejected_path:
        (landed.filter("_ok = 0").drop("_ok").write.mode("overwrite").option("partitionOverwriteMode", "static")
         .parquet(f"{rejected_path}/batch={batch_id}"))
    elif counts["rows_rejected"]:
        raise ValueError(f"batch {batch_id}: rows do not fit the table and no rejected_path is given")
    return landed.filter("_ok = 1").drop("_ok"), counts


def _report(spark: SparkSession, batch_id: int, counts: dict[str, int], keys: int, report_path: str | None) -> None:
    """One row per batch, as ``operators.relational.batch_report`` counts it; a replay overwrites it."""
    if report_path:
        row = {"batch_id": batch_id, **counts, "keys_upserted": keys}
        (spark.createDataFrame([row], "batch_id bigint, rows_in bigint, rows_written bigint, rows_rejected bigint, "
                                      "keys_upserted bigint")
         .coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static")
         .parquet(f"{report_path}/batch={batch_id}"))


def relational_sink(table: LakeTable, width: int | None = None,
                    limits: Mapping[str, int] | None = None,
                    rejected_path: str | None = None, report_path: str | None = None,
                    stream: str = "stream") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body for the current-state table kept as a keyed
    parquet table (key ``parcel_id``, last arrival wins).

    Rows that do not fit the table go to ``rejected_path`` with their reason; without it
    they fail the batch.  ``report_path`` keeps rows in / written / rejected and keys per
    batch, observed while the batch is written: it is computed once and never persisted.
    """
    def write(df: DataFrame, batch_id: int) -> None:
        if df.isEmpty():
            return
        prepared = conform_to_table(to_relational(df.withColumn("_batch_id", F.lit(batch_id).cast("long")))
                                    .withColumn("last_updated", F.current_timestamp()), limits)
        keys = Observation()
        with _landed(prepared, batch_id, rejected_path) as (valid, counts):
            if not counts["rows_written"]:
                _report(df.sparkSession, batch_id, counts, 0, report_path)
            elif _upsert(table, valid.drop("_batch_id", "_reject_reason"), batch_id, width, stream, keys):
                _report(df.sparkSession, batch_id, counts, keys.get["rows"], report_path)
            # else: the batch's report is that of its first write
    return write


def jdbc_sink(url: str, target: str, properties: Mapping[str, str] | None = None,
              limits: Mapping[str, int] | None = None, rejected_path: str | None = None,
              report_path: str | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body for a database table; rejected rows and reports as in
    :func:`relational_sink`."""
    def write(df: DataFrame, batch_id: int) -> None:
        if df.isEmpty():
            return
        keys = Observation()
        with _landed(prepare_batch(df, batch_id, limits), batch_id, rejected_path) as (valid, counts):
            jdbc_merge(valid, batch_id, url, target, properties, keys)
            _report(df.sparkSession, batch_id, counts, keys.get["rows"], report_path)
    return write


def console(df: DataFrame, num_rows: int = 50) -> DataStreamWriter:
    return (df.writeStream.format("console").option("truncate", "false")
            .option("numRows", str(num_rows)))


def parquet_sink(df: DataFrame, path: str) -> DataStreamWriter:
    return df.writeStream.format("parquet").option("path", path)


def jdbc_append(df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None) -> None:
    """Spark's built-in JDBC writer: append only (no upsert)."""
    df.write.mode("append").jdbc(url, table, properties=dict(properties or {}))
