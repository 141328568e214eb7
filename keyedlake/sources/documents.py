"""Document store: files as ``<base>/<parcel>/<file>``, their inventory, ingest and
new-only detection, plus a storage listing of any folder.

Folders are rows: tasks list them level by level into a table of files, and tasks that are
dealt those files by bytes read and hash them.  Neither names nor bytes pass through the
driver, and the number of tasks follows the bytes.  Stores that Arrow cannot open are
listed and read by Spark's ``binaryFile`` source, whose driver holds every file's status.
"""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.normalize import document_uri, file_class, size_kb
from ..session import scratch_path
from .lake import path_exists, qualified


#: Folder below a root of documents that lists its files; listings of the root skip it.
MANIFEST = "_manifest"
#: Bytes that one task reads, about, and the bytes that opening a file counts for.
TASK_BYTES = 128 << 20
OPEN_BYTES = 64 << 10
#: Bytes of content in one Arrow batch, unless a single row has more.
BATCH_BYTES = 8 << 20
#: Rows of a listing per Arrow batch and per Parquet file (a folder of any size is one task's, its rows are not).
LISTED_ROWS = 10_000
LISTED_FILE_ROWS = 100_000


def stage_documents(docs: DataFrame, root: str, parcel: str = "source", doc_id: str = "doc_id",
                    text: str = "text") -> None:
    """Write each document as ``<root>/<parcel>/doc-<id>.txt`` (its text and a newline),
    from the tasks that hold it, and list the files in the root's manifest."""
    def write(batches):
        import pyarrow as pa
        from pyarrow import fs as filesystems

        fs, base = filesystems.FileSystem.from_uri(root)
        made = set()
        for batch in batches:
            sizes = []
            for folder, name, content in zip(*(c.to_pylist() for c in batch.columns)):
                if folder not in made:
                    fs.create_dir(f"{base}/{folder}", recursive=True)
                    made.add(folder)
                data = (content + "\n").encode()
                with fs.open_output_stream(f"{base}/{folder}/{name}") as out:
                    out.write(data)
                sizes.append(len(data))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(sizes, pa.int64())],
                                  names=["parcel_id", "file_name", "length"])

    rows = docs.select(F.col(parcel).cast("string").alias("parcel"),
                       F.concat(F.lit("doc-"), F.col(doc_id).cast("string"), F.lit(".txt")).alias("file"),
                       F.coalesce(text, F.lit("")).alias("content"))
    (rows.mapInArrow(write, "parcel_id string, file_name string, length bigint")
     .write.mode("append").parquet(f"{root}/{MANIFEST}"))


def manifest_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Files per parcel as the root's manifest has them: a table read, nothing is listed."""
    return spark.read.parquet(f"{root}/{MANIFEST}").select("parcel_id", "file_name", "length").distinct()


def listed_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, parcel_id, file_name, length) of the files below ``root``; no content is read.
    Spark lists no empty files; a manifest has them."""
    return _listing(spark, root).select("path", "parcel_id", "file_name", "length")


def manifest_files(spark: SparkSession, root: str) -> DataFrame:
    """The same from the root's manifest."""
    return manifest_inventory(spark, root).select(
        F.concat_ws("/", F.lit(root.rstrip("/")), "parcel_id", "file_name").alias("path"),
        "parcel_id", "file_name", "length")


def reconcile(manifest: DataFrame, listing: DataFrame) -> DataFrame:
    """Files that only one of the two knows, or knows with another length: (parcel_id, file_name, state)."""
    keys = ["parcel_id", "file_name", "length"]
    manifest, listing = manifest.hint("merge"), listing.hint("merge")  # either side may be large: none goes through the driver
    gone = manifest.join(listing, keys, "left_anti").withColumn("state", F.lit("not in storage"))
    unknown = listing.join(manifest, keys, "left_anti").withColumn("state", F.lit("not in manifest"))
    return gone.select("parcel_id", "file_name", "state").unionByName(unknown.select("parcel_id", "file_name", "state"))


@functools.cache
def _store(scheme: str | None, authority: str):
    from pyarrow import fs

    if scheme in (None, "file"):
        return fs.LocalFileSystem(), ""
    store, base = fs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return store, base.rstrip("/")


def filesystem(path: str):
    """(file system, path within it) of a path as Spark lists it."""
    scheme, authority, rest = re.match(r"(?:([A-Za-z][A-Za-z0-9+.-]+):)?(?://([^/]*))?(.*)", path, re.S).groups()
    store, base = _store(scheme, authority or "")
    return store, base + rest


def _arrow_opens(root: str) -> bool:
    try:
        filesystem(root)
    except (pa.ArrowException, OSError):
        return False
    return True


def _hidden(name: str, folder: bool) -> bool:
    """Whether Spark's own listing passes over it."""
    if folder and name.startswith(("_metadata", "_common_metadata")):
        return False
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _entries(folder: str) -> Iterator[tuple]:
    """(name, whether a folder, length, modified in ms) in one folder."""
    from pyarrow import fs

    store, name = filesystem(folder)
    if isinstance(store, fs.LocalFileSystem):  # a stream of entries, however many there are
        with os.scandir(name) as found:
            for entry in found:
                try:
                    state, is_folder = entry.stat(), entry.is_dir()
                except FileNotFoundError:  # gone since
                    continue
                yield entry.name, is_folder, state.st_size, state.st_mtime_ns // 1_000_000
    else:
        for entry in store.get_file_info(fs.FileSelector(name)):
            yield entry.base_name, entry.type == fs.FileType.Directory, entry.size, (entry.mtime_ns or 0) // 1_000_000


_LISTED = "path string, folder boolean, length bigint, modificationTime timestamp"


def _list_folders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def batch(rows):
        path, folder, length, modified = zip(*rows)
        return pa.record_batch([pa.array(path, pa.string()), pa.array(folder, pa.bool_()), pa.array(length, pa.int64()),
                                pa.array([1000 * ms for ms in modified], pa.timestamp("us", "UTC"))],
                               names=["path", "folder", "length", "modificationTime"])

    for given in batches:
        for path in given.column("path").to_pylist():
            rows = []
            for name, folder, length, modified in _entries(path):
                if not _hidden(name, folder):
                    rows.append((f"{path.rstrip('/')}/{name}", folder, length or 0, modified))
                if len(rows) == LISTED_ROWS:
                    yield batch(rows)
                    rows = []
            if rows:
                yield batch(rows)


def _listing(spark: SparkSession, root: str) -> DataFrame:
    """Files below ``root`` as they are now: path, length, modificationTime, parcel_id, file_name;
    parcel and file name are the last two parts of the path.

    Each level's folders are dealt to tasks, which list them into a table; the next level is read from it.
    """
    if not _arrow_opens(root := qualified(spark, root)):
        return _spark_listing(spark, root)
    table, levels = scratch_path(spark, "listing"), []
    folders, tasks = spark.createDataFrame([(root,)], "path string"), 1
    while tasks:
        levels.append(f"{table}/level-{len(levels)}")
        (folders.repartition(tasks).mapInArrow(_list_folders, _LISTED)
         .write.option("maxRecordsPerFile", LISTED_FILE_ROWS).parquet(levels[-1]))
        folders = spark.read.schema(_LISTED).parquet(levels[-1]).filter("folder").select("path")
        tasks = min(folders.count(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    return _named(spark.read.schema(_LISTED).parquet(*levels).filter("NOT folder AND length > 0").drop("folder"))


def _spark_listing(spark: SparkSession, root: str, with_content: bool = False) -> DataFrame:
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return _named(df if with_content else df.drop("content"))


def _named(files: DataFrame) -> DataFrame:
    parts = F.split("path", "/")
    return files.withColumns({"parcel_id": F.element_at(parts, -2), "file_name": F.element_at(parts, -1)})


def read_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (path, offset, size, ...) with the bytes they name as ``content`` in place of path and size."""
    opened, file = None, None
    for batch in batches:
        rest = batch.drop_columns(["path", "size"])
        held, first, contents = 0, 0, []
        for path, offset, size in zip(*(batch.column(c).to_pylist() for c in ("path", "offset", "size"))):
            if contents and held + size > BATCH_BYTES:
                yield rest.slice(first, len(contents)).append_column("content", pa.array(contents, pa.binary()))
                held, first, contents = 0, first + len(contents), []
            if path != opened:
                if file is not None:
                    file.close()
                store, name = filesystem(path)
                opened, file = path, store.open_input_file(name)
            file.seek(offset)
            data = file.read(size)
            if len(data) != size:
                raise OSError(f"{path} ends before byte {offset + size}: it changed while it was read")
            contents.append(data)
            held += size
        if contents:
            yield rest.slice(first).append_column("content", pa.array(contents, pa.binary()))
    if file is not None:
        file.close()


def _contents(spark: SparkSession, root: str, stored: DataFrame | None = None) -> DataFrame:
    """(parcel_id, file_name, length, content) of the files below ``root`` that ``stored`` lacks, read whole
    by tasks that are dealt them by bytes."""
    new = (lambda files: files) if stored is None else functools.partial(new_only, stored=stored)
    if not _arrow_opens(qualified(spark, root)):
        return new(_spark_listing(spark, root, with_content=True)).select("parcel_id", "file_name", "length", "content")
    files = new(_listing(spark, root))
    total = files.agg(F.sum(F.col("length") + OPEN_BYTES)).first()[0] or 0
    ranges = files.select("path", F.lit(0).cast("bigint").alias("offset"), F.col("length").alias("size"),
                          "parcel_id", "file_name", "length").repartition(max(1, -(-total // TASK_BYTES)))
    return (ranges.mapInArrow(read_ranges, "offset bigint, parcel_id string, file_name string, length bigint, content binary")
            .drop("offset"))


def document_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Files per parcel with name and size (a parcel is a directory)."""
    return _listing(spark, root).select("parcel_id", "file_name", "length",
                                        F.col("modificationTime").alias("modification_time"))


def document_digests(spark: SparkSession, root: str) -> DataFrame:
    """(parcel_id, file_name, length, sha2) of small files, read whole."""
    return _contents(spark, root).select("parcel_id", "file_name", "length", F.sha2("content", 256).alias("sha2"))


def document_ingest(spark: SparkSession, staged_root: str, store: str, uri_root: str,
                    kind: str = "title", buckets: int = 64) -> DataFrame:
    """Store staged files that are not stored yet as rows ``(parcel_id, file_name, length,
    sha2, uri, content)`` of parquet, partitioned by a hash bucket of the parcel; return all
    stored rows.  ``uri`` is the document's name below ``uri_root``; its bytes are the
    stored row's ``content``."""
    bucket = F.pmod(F.xxhash64("parcel_id"), F.lit(buckets)).cast("int")
    rows = _contents(spark, staged_root, spark.read.parquet(store) if path_exists(spark, store) else None)
    rows = rows.select("parcel_id", "file_name", "length", F.sha2(F.col("content"), 256).alias("sha2"), "content",
                       document_uri(uri_root, "parcel_id", "file_name", kind).alias("uri"),
                       bucket.alias("_bucket"))
    # rebalance: one writer per bucket, a hot parcel split by AQE into ~128 MB files
    rows.hint("rebalance", "_bucket").write.mode("append").partitionBy("_bucket").parquet(store)
    return spark.read.parquet(store)


def document_rows(docs: DataFrame, uri_root: str, kind: str = "title") -> DataFrame:
    """Documents table rows as store keys: parcel = source, file = doc-<id>.txt."""
    return docs.select(
        F.col("doc_id"),
        F.col("source").alias("parcel_id"),
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("file_name"),
    ).withColumn("uri", document_uri(uri_root, "parcel_id", "file_name", kind))


def new_only(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """Incoming documents not yet stored (idempotent ingest)."""
    return incoming.join(stored.select("parcel_id", "file_name"), ["parcel_id", "file_name"], "left_anti")


def storage_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Recursive file listing: class PARQUET / LOG / OTHER and size in whole KB.
    Hidden metadata directories (``_timeline``, ``_index``) are skipped by
    the listing itself."""
    return _listing(spark, root).select("path", "file_name", file_class("file_name").alias("file_class"),
                                        size_kb("length").alias("size_kb"))
