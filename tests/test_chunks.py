"""Documents larger than a row: byte ranges, digests, restore, manifest."""

import hashlib
import os
import random

import pytest
from pyspark.sql import functions as F

from keyedlake.sources import chunks as CH
from keyedlake.sources import documents as D


def write(root, files):
    for (parcel, name), data in files.items():
        os.makedirs(f"{root}/{parcel}", exist_ok=True)
        with open(f"{root}/{parcel}/{name}", "wb") as f:
            f.write(data)


def chain(data, size):
    parts = [hashlib.sha256(data[i:i + size]).hexdigest() for i in range(0, max(len(data), 1), size)]
    return parts[0] if len(parts) == 1 else hashlib.sha256("".join(parts).encode()).hexdigest()


FILES = {("p1", "three chunks.bin"): random.Random(1).randbytes(2500), ("p1", "exact.bin"): b"x" * 2000,
         ("p2", "empty.txt"): b"", ("p2", "one.txt"): b"a", ("é%20", "odd name #1.txt"): b"\x00\xff" * 700}


@pytest.fixture
def staged(spark, tmp_table):
    root = tmp_table("chunk-files")
    write(root, FILES)
    return root


def test_files_come_back_equal(spark, tmp_table, staged):
    store, back = tmp_table("chunk-store"), tmp_table("chunk-back")
    empty = spark.createDataFrame([(f"{staged}/p2/empty.txt", "p2", "empty.txt", 0)],  # Spark's listing has no empty files
                                  "path string, parcel_id string, file_name string, length bigint")
    files = D.listed_files(spark, staged).unionByName(empty)
    got = CH.ingest_chunks(spark, files, store, "root", chunk_bytes=1000).collect()
    assert {(r.parcel_id, r.file_name): (r.length, r.n_chunks, r.complete, r.digest) for r in got} == {
        k: (len(v), max(1, -(-len(v) // 1000)), True, chain(v, 1000)) for k, v in FILES.items()}
    restored = CH.restore(spark, store, back)
    assert {(r.parcel_id, r.file_name, r.length) for r in restored.collect()} == {(*k, len(v)) for k, v in FILES.items()}
    for (parcel, name), data in FILES.items():
        with open(f"{back}/{parcel}/{name}", "rb") as f:
            assert f.read() == data


def test_ingest_adds_only_new_files(spark, tmp_table, staged):
    store = tmp_table("chunk-store")
    CH.ingest_chunks(spark, D.listed_files(spark, staged), store, "root", chunk_bytes=1000)
    rows = spark.read.parquet(store).count()
    write(staged, {("p3", "new.txt"): b"new" * 500})
    assert CH.ingest_chunks(spark, D.listed_files(spark, staged), store, "root", chunk_bytes=1000).count() == len(FILES)
    assert spark.read.parquet(store).count() == rows + 2


def test_a_file_that_shrinks_fails_the_write(spark, tmp_table, staged):
    files = D.listed_files(spark, staged).withColumn("length", F.col("length") + 1)
    with pytest.raises(Exception, match="changed while it was read"):
        CH.ingest_chunks(spark, files, tmp_table("chunk-store"), "root", chunk_bytes=1000)


def test_a_hot_parcel_is_spread_and_no_bytes_are_shuffled(spark, monkeypatch):
    monkeypatch.setattr(CH, "TASK_BYTES", 10_000)
    files = spark.createDataFrame([(f"file:/x/p/{i}", "p", f"{i}", 5000 + i) for i in range(40)],
                                  "path string, parcel_id string, file_name string, length bigint")
    dealt = CH._dealt(CH.ranges_of(files, 1000, 8))
    per_task = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == files.selectExpr("sum(ceil(length / 1000))").first()[0] and max(per_task) < 240 / 2
    assert "content" not in dealt.columns


def test_manifest_against_storage(spark, tmp_table):
    root = tmp_table("manifest")
    docs = spark.createDataFrame([(1, "s", "one"), (2, "t", None), (3, "s", "three")], "doc_id long, source string, text string")
    D.stage_documents(docs, root)
    key = lambda df: sorted(map(tuple, df.select("parcel_id", "file_name", "length").collect()))
    assert key(D.manifest_inventory(spark, root)) == key(D.document_inventory(spark, root)) == [
        ("s", "doc-1.txt", 4), ("s", "doc-3.txt", 6), ("t", "doc-2.txt", 1)]
    os.remove(f"{root.removeprefix('file:')}/t/doc-2.txt")
    write(root, {("u", "stray.txt"): b"!"})
    found = D.reconcile(D.manifest_inventory(spark, root), D.listed_files(spark, root).drop("path"))
    assert sorted(map(tuple, found.collect())) == [("t", "doc-2.txt", "not in storage"), ("u", "stray.txt", "not in manifest")]


def test_a_listing_is_made_by_tasks_and_is_spark_s_own(spark, staged, monkeypatch):
    write(staged, {("p1/deep/er", "x.log"): b"12", ("p1/_metadata_x", "seen.txt"): b"1", ("_hid", "no.txt"): b"1", ("p2", ".no"): b"1",
                   ("p2", "_k=1"): b"1", ("p2", "_no"): b"1", ("p2", "x._COPYING_"): b"1", ("", "top.txt"): b"abc"})
    names = ["path", "length", "modificationTime", "parcel_id", "file_name"]
    rows = lambda df: sorted(map(tuple, df.select(names).collect()))
    want = rows(D._spark_listing(spark, staged))
    monkeypatch.setattr(D, "_spark_listing", None)  # the driver lists nothing
    got = D._listing(spark, staged)
    assert rows(got) == want and len(want) == 8
    write(staged, {("p4", "later.txt"): b"1"})
    assert rows(got) == want and len(rows(D._listing(spark, staged))) == 9


def test_small_files_share_tasks(spark, tmp_table):
    """They were dealt 32 a task, as a file's opening counted for 4 MB."""
    root = tmp_table("many-small")
    write(root, {(f"p{i % 3}", f"{i}.txt"): b"x%d" % i for i in range(900)})
    digests = D.document_digests(spark, root)
    assert digests.rdd.getNumPartitions() == 1 and D.listed_files(spark, root).rdd.getNumPartitions() < 20
    assert {(r.file_name, r.length, r.sha2) for r in digests.collect()} == {
        (f"{i}.txt", len(b"x%d" % i), hashlib.sha256(b"x%d" % i).hexdigest()) for i in range(900)}


def test_ranges_are_read_in_batches(tmp_path, monkeypatch):
    """Each range was a batch of its own."""
    import pyarrow as pa

    (tmp_path / "f").write_bytes(b"0123456789" * 10)
    monkeypatch.setattr(D, "BATCH_BYTES", 30)
    given = pa.table({"path": [str(tmp_path / "f")] * 11, "offset": [10 * i for i in range(10)] + [0], "size": [10] * 10 + [90]}).to_batches()
    got = list(D.read_ranges(given))
    assert [b.num_rows for b in got] == [3, 3, 3, 1, 1] and got[0].schema.names == ["offset", "content"]
    assert b"".join(pa.Table.from_batches(got)["content"].to_pylist()) == b"0123456789" * 19


def test_ranges_are_dealt_by_number_too_and_a_small_file_stays_together(spark, monkeypatch):
    monkeypatch.setattr(CH, "TASK_BYTES", 80_000)
    files = spark.createDataFrame([(f"file:/x/p/{i}", "p", f"{i}", 30) for i in range(100)],
                                  "path string, parcel_id string, file_name string, length bigint")
    dealt = CH._dealt(CH.ranges_of(files, 10, 8)).withColumn("task", F.spark_partition_id())
    assert dealt.count() == 300 and dealt.select("task").distinct().count() > 2  # by their bytes alone it was one
    assert dealt.select("path", "task").distinct().count() == 100


def test_a_restore_lists_its_files_as_it_goes(spark, tmp_table, staged):
    store, back = tmp_table("chunk-store"), tmp_table("chunk-back")
    CH.ingest_chunks(spark, D.listed_files(spark, staged), store, "root", chunk_bytes=700)
    assert {(r.parcel_id, r.file_name, r.length) for r in CH.restore(spark, store, back).collect()} == {
        (*k, len(v)) for k, v in FILES.items() if v}
    assert {(r.parcel_id, r.file_name, r.sha2) for r in D.document_digests(spark, back).collect()} == {
        (*k, hashlib.sha256(v).hexdigest()) for k, v in FILES.items() if v}


def test_neither_side_of_a_reconciliation_goes_through_the_driver(spark):
    side = spark.createDataFrame([("p", "f", 1), ("p", "f", 1), (None, "f", 1)], "parcel_id string, file_name string, length bigint")
    found = D.reconcile(side, side.filter("parcel_id IS NOT NULL"))
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert list(map(tuple, found.collect())) == [(None, "f", "not in storage")]
