"""Documents larger than a row: files are read as byte ranges and stored as chunks.

A listed file becomes ranges of ``chunk_bytes``; the ranges (narrow rows) are dealt to tasks
by bytes, and each task reads its ranges and writes them where they belong, so that
bytes are never shuffled and a task holds one batch of chunks, or one chunk, at a time however
large a file is.

``digest`` is the SHA-256 of a file of one chunk; of a file of several, that of its
chunks' digests (lower-case hex, in chunk order), which needs no pass over the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.normalize import document_uri
from .documents import TASK_BYTES, filesystem, new_only, read_ranges
from .lake import path_exists

CHUNK_BYTES = 8 << 20
#: Bytes that a range counts for besides its own.
RANGE_BYTES = 4 << 10


def ranges_of(files: DataFrame, chunk_bytes: int = CHUNK_BYTES, buckets: int = 64) -> DataFrame:
    """One row per byte range of ``files`` (path, parcel_id, file_name, length); an empty file has one empty range."""
    n = F.greatest(F.ceil(F.col("length") / chunk_bytes), F.lit(1)).cast("int")
    return (files.select("path", "parcel_id", "file_name", "length", n.alias("n_chunks"),
                         F.pmod(F.xxhash64("parcel_id"), F.lit(buckets)).cast("int").alias("_bucket"))
            .select("*", F.explode(F.sequence(F.lit(0), F.col("n_chunks") - 1)).alias("chunk_no"))
            .withColumn("offset", F.col("chunk_no").cast("long") * chunk_bytes)
            .withColumn("size", F.least(F.col("length") - F.col("offset"), F.lit(chunk_bytes))))


def _dealt(ranges: DataFrame) -> DataFrame:
    """Ranges of one bucket in as many tasks as its bytes ask for; only narrow rows move.

    The number of tasks is given, as adaptive execution would join them by the narrow rows' own size.
    """
    sizes = ranges.groupBy("_bucket").agg(F.sum(F.col("size") + RANGE_BYTES)).collect()  # a row a bucket
    shares = ranges.sparkSession.createDataFrame([(bucket, -(-size // TASK_BYTES)) for bucket, size in sizes],
                                                 "_bucket int, _shares bigint")
    # neighbouring ranges stay together, so that a small file is opened once
    stretch = F.floor(F.col("offset") / max(1, TASK_BYTES // 8))
    return (ranges.join(F.broadcast(shares), "_bucket").withColumn("_share", F.pmod(F.xxhash64("path", stretch), "_shares"))
            .repartition(max(1, 2 * -(-sum(size for _, size in sizes) // TASK_BYTES)), "_bucket", "_share")
            .sortWithinPartitions("_bucket", "path", "chunk_no").drop("_share", "_shares"))


def ingest_chunks(spark: SparkSession, files: DataFrame, store: str, uri_root: str, kind: str = "title",
                  chunk_bytes: int = CHUNK_BYTES, buckets: int = 64) -> DataFrame:
    """Store ``files`` that are not stored yet; return all stored files (:func:`stored_files`).

    ``store`` holds rows (parcel_id, file_name, length, n_chunks, chunk_no, offset, content, chunk_sha2,
    uri), partitioned by a hash bucket of the parcel.  The write is one Spark job: it adds all
    its files or none.
    """
    if path_exists(spark, store):
        files = new_only(files, spark.read.parquet(store).filter("chunk_no = 0"))
    ranges = _dealt(ranges_of(files, chunk_bytes, buckets))
    schema = "parcel_id string, file_name string, length bigint, n_chunks int, _bucket int, chunk_no int, offset bigint, content binary"
    columns = [c.strip().split()[0] for c in schema.split(",")][:-1]
    read = ranges.select("path", "size", *columns).mapInArrow(read_ranges, schema)
    (read.withColumn("chunk_sha2", F.sha2("content", 256))
     .withColumn("uri", document_uri(uri_root, "parcel_id", "file_name", kind))
     .write.mode("append").partitionBy("_bucket").parquet(store))
    return stored_files(spark, store)


def stored_files(spark: SparkSession, store: str) -> DataFrame:
    """Per stored file: parcel_id, file_name, length, n_chunks, complete, digest, uri; no content is read."""
    chunks = F.array_sort(F.collect_list(F.struct("chunk_no", "chunk_sha2")))
    joined = F.array_join(F.transform(chunks, lambda c: c["chunk_sha2"]), "")
    return (spark.read.parquet(store).groupBy("parcel_id", "file_name", "length", "n_chunks", "uri")
            .agg(F.count(F.lit(1)).alias("_stored"), joined.alias("_digests"))
            .select("parcel_id", "file_name", "length", "n_chunks", (F.col("_stored") == F.col("n_chunks")).alias("complete"),
                    F.when(F.col("n_chunks") == 1, F.col("_digests")).otherwise(F.sha2("_digests", 256)).alias("digest"),
                    "uri"))


def restore(spark: SparkSession, store: str, root: str) -> DataFrame:
    """Write the stored files back as ``<root>/<parcel>/<file>``; returns (parcel_id, file_name, length).

    A file's chunks arrive in order and are appended as they come, so a task holds one batch of them.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def written(done):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), (pa.string(), pa.string(), pa.int64()))],
                                              names=["parcel_id", "file_name", "length"])

        fs, base = filesystem(root)
        made, name, out = set(), None, None
        for batch in batches:
            done = []
            for parcel, file, content in zip(*(batch.column(c).to_pylist() for c in ("parcel_id", "file_name", "content"))):
                if (parcel, file) != name:
                    if out is not None:
                        done.append((*name, out.tell()))
                        out.close()
                    if parcel not in made:
                        fs.create_dir(f"{base}/{parcel}", recursive=True)
                        made.add(parcel)
                    name, out = (parcel, file), fs.open_output_stream(f"{base}/{parcel}/{file}")
                out.write(content)
            if done:
                yield written(done)
        if out is not None:
            length = out.tell()
            out.close()
            yield written([(*name, length)])

    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20))
    rows = (spark.read.parquet(store).select("parcel_id", "file_name", "chunk_no", "content")
            .repartition("parcel_id", "file_name").sortWithinPartitions("parcel_id", "file_name", "chunk_no"))
    (rows.mapInArrow(write, "parcel_id string, file_name string, length bigint")
     .write.parquet(f"{root}/_manifest"))
    return spark.read.parquet(f"{root}/_manifest")
