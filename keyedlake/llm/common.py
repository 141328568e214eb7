"""Helpers shared by the operators: table access, Arrow slices, digests, staging."""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: Bytes of text that a task works on at a time (one longer text is taken whole).
SLICE_BYTES = 4 << 20
#: Bytes that Spark puts into one Arrow batch for a Python worker.
ARROW_BATCH_BYTES = 16 << 20

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str) -> DataFrame:
    """``mapInArrow`` with batches bounded by bytes as well as rows."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))
    return df.mapInArrow(fn, schema)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of one slice hold about ``limit`` bytes."""
    import pyarrow.compute as pc

    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        begin = total = 0
        for i, n in enumerate(sizes):
            if i > begin and total + n > limit:
                yield batch.slice(begin, i - begin)
                begin, total = i, 0
            total += n
        if begin < len(sizes):
            yield batch.slice(begin)


def share(spark: SparkSession, value) -> Broadcast:
    """Broadcast an object of this subpackage's classes: pickled by value, as functions are, so that
    workers need no copy of the package.  Tasks read it with :func:`shared`."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def shared(handle: Broadcast):
    return pickle.loads(handle.value)


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the cluster's shared checkpoint folder and read it back.

    This cuts lineage: a lost executor costs the rerun of single tasks only.
    """
    path = scratch_path(df.sparkSession, f"llm-{name}")
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, "false")
    conf.set(_CLEANUP, "true")  # what was shuffled for the table isn't needed once it is written
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        conf.set(_CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(df: DataFrame, column: str = "text") -> int:
    """Bytes of all texts; sizes the number of buckets so that one bucket stays bounded."""
    return df.agg(F.sum(F.octet_length(column))).first()[0] or 0
