"""Relational current-state table: one row per ``parcel_id``, last arrival wins.

The core is pure DataFrame work done on executors (no collect):

* :func:`last_arrival`      reduce a batch (or several) to the last arrival
                            per key, ordered by ``(batch, partition, offset)``
* :func:`upsert_last_arrival`  current state ``left_anti`` batch keys, union
* :func:`batch_report`      per-batch rows in / written / rejected

:func:`jdbc_merge` is the database leg: the reduced batch goes to a staging
table through Spark's parallel JDBC writer and one ``MERGE`` statement runs
on the driver's connection.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.normalize import conform_to_table, split_valid_rejected, to_relational
from ..schema import RELATIONAL_COLUMNS, RELATIONAL_KEY
from .versioned import latest_per_group

ARRIVAL_ORDER = ("_batch_id", "kafka_partition", "kafka_offset")
# Inside a stored table the batch is the commit, so rows order by position only.
TABLE_ORDER = ("kafka_partition", "kafka_offset")


def last_arrival(rows: DataFrame, key: str = RELATIONAL_KEY,
                 order: Sequence[str] = ARRIVAL_ORDER) -> DataFrame:
    """Last arrival per key; a later arrival wins even with an older event time."""
    present = [c for c in order if c in rows.columns]
    return latest_per_group(rows, [key], [F.col(c).desc_nulls_last() for c in present])


def upsert_last_arrival(current: DataFrame, batch: DataFrame,
                        key: str = RELATIONAL_KEY) -> DataFrame:
    """Insert new keys, overwrite existing ones with the batch's last arrival."""
    incoming = last_arrival(batch, key)
    kept = current.join(incoming.select(key), [key], "left_anti")
    return kept.unionByName(incoming, allowMissingColumns=True)


def prepare_batch(parsed: DataFrame, batch_id: int | None = None,
                  limits: Mapping[str, int] | None = None) -> DataFrame:
    """Parsed transactions -> relational rows with ``_reject_reason``."""
    rows = parsed if batch_id is None else parsed.withColumn("_batch_id", F.lit(batch_id).cast("long"))
    return conform_to_table(to_relational(rows), limits)


def valid_and_rejected(parsed: DataFrame, batch_id: int | None = None,
                       limits: Mapping[str, int] | None = None) -> tuple[DataFrame, DataFrame]:
    return split_valid_rejected(prepare_batch(parsed, batch_id, limits))


def batch_report(prepared: DataFrame, batch_col: str = "_batch_id") -> DataFrame:
    """One row per batch: rows in, rows written (accepted), rows rejected,
    and distinct keys upserted.  One aggregation, partial per task."""
    ok = F.col("_reject_reason").isNull()
    return prepared.groupBy(F.col(batch_col).alias("batch_id")).agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count(F.when(ok, 1)).alias("rows_written"),
        F.count(F.when(~ok, 1)).alias("rows_rejected"),
        F.count_distinct(F.when(ok, F.col(RELATIONAL_KEY))).alias("keys_upserted"),
    )


def table_columns(with_stamp: bool = False) -> list[str]:
    cols = [c for c, _, _, _ in RELATIONAL_COLUMNS]
    return cols + (["last_updated"] if with_stamp else [])


def merge_statement(target: str, staging: str, key: str = RELATIONAL_KEY) -> str:
    """ANSI ``MERGE`` from the staging table (Spark writes quoted lower-case
    column names, so the text quotes them too)."""
    cols = table_columns()
    q = lambda c: f'"{c}"'
    sets = ", ".join(f"{q(c)} = s.{q(c)}" for c in cols if c != key)
    ins_cols = ", ".join(q(c) for c in cols)
    ins_vals = ", ".join(f"s.{q(c)}" for c in cols)
    return (
        f"MERGE INTO {target} t USING {staging} s ON t.{q(key)} = s.{q(key)} "
        f"WHEN MATCHED THEN UPDATE SET {sets}, {q('last_updated')} = CURRENT_TIMESTAMP "
        f"WHEN NOT MATCHED THEN INSERT ({ins_cols}, {q('last_updated')}) "
        f"VALUES ({ins_vals}, CURRENT_TIMESTAMP)"
    )


def jdbc_merge(valid: DataFrame, batch_id: int, url: str, target: str,
               properties: Mapping[str, str] | None = None, seen: Observation | None = None) -> None:
    """Merge valid relational rows into the database table; ``seen`` observes the number of keys.

    Reduce to the last arrival per key on executors, write a staging table with
    Spark's parallel JDBC writer, then one ``MERGE`` on the driver connection.
    """
    props = dict(properties or {})
    staging = f"{target}_staging_{batch_id}"
    (last_arrival(valid).select(*table_columns()).observe(seen or Observation(), F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite").jdbc(url, staging, properties=props))
    jvm = valid.sparkSession.sparkContext._jvm
    conn = jvm.java.sql.DriverManager.getConnection(url, props.get("user"), props.get("password"))
    try:
        conn.setAutoCommit(False)
        st = conn.createStatement()
        st.executeUpdate(merge_statement(target, staging))
        st.executeUpdate(f"DROP TABLE {staging}")
        conn.commit()
    finally:
        conn.close()
