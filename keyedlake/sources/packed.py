"""Append to a Parquet table so that its files stay near a target size.

A batch is landed as it is.  Landed files and files of earlier batches that are underfull
(below ``small``) are laid end to end by a running sum of their sizes, and cut anew every
``target`` bytes: a row goes to the file that its place in the sum falls into.  So all but the
last file of a running sum come out full, and full files are never touched again.

Layout: every file is alone in a folder ``data/_write=<id>/_file=<name>/`` (names begin with a letter, so
that Spark takes them for text); ``files/`` is a
Parquet list of (write, file, bytes, rows, replaced) that is written once per append, last.
A file counts if it is listed and no later write replaces it, so readers see an append
whole or not at all, and a failed one leaves nothing that counts.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .lake import path_exists

#: Bytes of a full file, and below which a file is topped up (fixed values).
TARGET_BYTES, SMALL_BYTES = 120 << 20, 104 << 20
#: Files of the target size that one running sum covers, about; sums run side by side over hashed groups of files.
BINS_A_GROUP = 64

_FILES = "write string, file string, bytes bigint, rows bigint, replaced int"
_FILE = ["write", "file"]


def _listed(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.schema(_FILES).parquet(f"{path}/files") if path_exists(spark, f"{path}/files")
            else spark.createDataFrame([], _FILES))


def live_files(spark: SparkSession, path: str) -> DataFrame:
    """(write, file, bytes, rows) of the files that make up the table."""
    listed = _listed(spark, path)
    gone = listed.filter("replaced = 1").select(*_FILE)
    return listed.filter("replaced = 0").join(gone, _FILE, "left_anti").drop("replaced")


def _scan(spark: SparkSession, path: str, writes: str = "*") -> DataFrame:
    return (spark.read.option("basePath", f"{path}/data").option("mergeSchema", "true")
            .parquet(f"{path}/data/_write={writes}"))


def _of(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Rows of ``files``; the join is on folder names, which prune the scan at run time."""
    return rows.join(files, (rows["_write"] == files["write"]) & (rows["_file"] == files["file"]))


def read_packed(spark: SparkSession, path: str) -> DataFrame:
    rows = _scan(spark, path)
    return _of(rows, live_files(spark, path)).select(*[c for c in rows.columns if c not in ("_write", "_file")])


def _written(spark: SparkSession, path: str, write: str) -> DataFrame:
    """(write, file, bytes, rows) of what a write has left; footers are read, no columns."""
    names = spark.read.schema("_write string, _file string").option("basePath", f"{path}/data")
    return (names.parquet(f"{path}/data/_write={write}").groupBy(F.col("_write").alias("write"), F.col("_file").alias("file"))
            .agg(F.max("_metadata.file_size").alias("bytes"), F.count(F.lit(1)).alias("rows")))


def _write(rows: DataFrame, path: str, write: str) -> None:
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("_file")
     .parquet(f"{path}/data/_write={write}"))


def places_of(files: DataFrame, target: int = TARGET_BYTES) -> DataFrame:
    """``files`` with the group and the place (in bytes) where each begins in its group's running sum."""
    total = files.agg(F.sum("bytes")).first()[0] or 0
    group = F.pmod(F.xxhash64("write", "file"), F.lit(max(1, total // (target * BINS_A_GROUP))))
    before = Window.partitionBy("group").orderBy("write", "file").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("group", group).withColumn("begins", F.coalesce(F.sum("bytes").over(before), F.lit(0)))


def append_packed(rows: DataFrame, path: str, target: int = TARGET_BYTES, small: int = SMALL_BYTES) -> str | None:
    """Append ``rows``; returns the write's id, or None for an empty batch (nothing is listed)."""
    spark = rows.sparkSession
    write = f"w{uuid.uuid4().hex}"
    landed, packed = f"{write}-landed", f"{write}-packed"
    _write(rows.withColumn("_file", F.concat(F.lit("f"), F.spark_partition_id())), path, landed)
    came = _written(spark, path, landed).filter("rows > 0")
    small_ones = came.unionByName(live_files(spark, path)).filter(F.col("bytes") < small)
    counts = came.agg(F.count(F.lit(1))).first()[0], small_ones.agg(F.count(F.lit(1))).first()[0]
    if not counts[0]:
        return None
    if counts[1] < 2:  # nothing to top up
        listed = came.withColumn("replaced", F.lit(0))
    else:
        places = places_of(small_ones, target)
        data = _scan(spark, path)
        columns = [c for c in data.columns if c not in ("_write", "_file")]
        at = F.col("begins") + F.col("bytes") * F.col("_row") / F.col("rows")
        binned = (_of(data.withColumn("_row", F.col("_metadata.row_index")), places)
                  .select(*columns, F.concat(F.lit("f"), "group", F.lit("-"), F.floor(at / target)).alias("_file")))
        n_bins = places.agg((F.floor(F.sum("bytes") / target) + F.max("group") + 1).cast("int")).first()[0]
        _write(binned.repartition(n_bins, "_file"), path, packed)
        listed = (came.filter(F.col("bytes") >= small).unionByName(_written(spark, path, packed))
                  .withColumn("replaced", F.lit(0))
                  .unionByName(small_ones.filter(F.col("write") != landed).withColumn("replaced", F.lit(1))))
    listed.coalesce(1).write.mode("append").parquet(f"{path}/files")
    return write


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete the folders of writes none of whose files count any more; returns how many.  No reader or
    writer may be at work."""
    from .lake import delete_path

    listed = _listed(spark, path).select("write").distinct()
    dead = listed.join(live_files(spark, path).select("write").distinct(), "write", "left_anti")
    n = 0
    for row in dead.toLocalIterator():  # folder names, one a write
        delete_path(spark, f"{path}/data/_write={row['write']}")
        n += 1
    return n
