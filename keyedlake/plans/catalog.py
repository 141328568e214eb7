"""Query catalogue: one Spark callable per operator, plus the DuckDB oracle.

Every query reads the driver tables at ``sf_dir`` (or data Spark derives
from them) and runs over the whole tables.  Read modes use the pure
changelog functions; write modes, streaming and documents write real
tables under the session's shared checkpoint folder and read them back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import normalize as N
from ..functions import parse as P
from ..operators import relational as R
from ..operators import versioned as V
from ..schema import COMMIT_TIME, ENVELOPE_SCHEMA, TRANSACTION_COLUMNS, TRANSACTION_SCHEMA
from ..session import scratch_path
from ..sources import bucketed as BK
from ..sources import chunks as CH
from ..sources import documents as D
from ..sources.files import file_stream
from ..sources import packed as PK
from ..sources.lake import LakeTable
from ..streaming import runner as RUN
from ..streaming import sinks as SK
from ..streaming import windows as WIN
from . import fixtures as FX
from . import reports as REP

TXN_OUT = FX.TXN_OUT
REL_OUT = R.table_columns()
REJECT_LIMITS = {"area": 5}
HIGH_VALUE = 100.0
DOCUMENT_ROOT = "hdfs://store/files"
BUCKETS = 8


# ---------------------------------------------------------------- helpers
def _pre(spark: SparkSession, sf: str, src=FX.txe) -> DataFrame:
    """Changelog: each commit's batch precombined (one row per key per commit)."""
    return V.precombine(src(spark, sf), within=[COMMIT_TIME])


def _txo_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return V.snapshot(FX.txo(spark, sf))


def _batches(df: DataFrame, commits=FX.TXE_COMMITS):
    for c in commits:
        yield c, df.filter(F.col(COMMIT_TIME) == c).drop(COMMIT_TIME)


def _lake(spark: SparkSession, name: str, **kw) -> LakeTable:
    return LakeTable(spark, scratch_path(spark, name), buckets=BUCKETS, **kw)


def _events_stream(spark: SparkSession, sf: str) -> DataFrame:
    schema = FX.table(spark, sf, "events").schema
    return file_stream(spark, sf, schema, glob="events.parquet")


# ---------------------------------------------------------------- parse / project
def q_parse_transactions(spark, sf):
    return P.parse_transactions(FX.env(spark, sf), layout="table")


def q_parse_all_messages(spark, sf):
    return P.parse_transactions(FX.env(spark, sf), layout="console")


def q_quarantine_messages(spark, sf):
    """All messages, kept or set aside with a reason: kept + quarantined = read."""
    kept, aside = P.split_messages(FX.env_with_bad_messages(spark, sf))
    tell = lambda df, state, reason: df.select("kafka_offset", F.lit(state).alias("state"), reason)
    return tell(kept, "kept", F.lit(None).cast("string").alias("reason")).unionByName(
        tell(aside, "quarantined", F.col("reason")))


def q_kafka_envelope(spark, sf):
    e = P.envelope_columns(FX.env(spark, sf))
    return e.select("kafka_key", "kafka_partition", "kafka_offset", "kafka_timestamp")


def q_json_props(spark, sf):
    ev = FX.table(spark, sf, "events")
    return ev.select("event_id", P.json_field(F.col("props"), "k", "int").alias("k"))


def q_high_value_filter(spark, sf):
    return P.high_value(FX.txe(spark, sf), HIGH_VALUE).select(*TXN_OUT)


def _raw_event_time(ev: DataFrame) -> DataFrame:
    v = F.col("event_id") % 8
    raw = (F.when(v == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
           .when(v == 1, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
           .when(v == 2, F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
           .when(v == 3, F.date_format("ts", "yyyy-M-d'T'HH:mm:ss"))
           .when(v == 4, F.date_format("ts", "yyyy-MM-dd"))
           .when(v == 5, F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+08:00")))
           .when(v == 6, F.lit("   "))
           .otherwise(F.concat(F.lit("pending#"), F.col("event_id").cast("string"))))
    return ev.select("event_id", raw.alias("raw"))


def q_event_time_parse(spark, sf):
    raw = _raw_event_time(FX.table(spark, sf, "events"))
    return raw.select("event_id", "raw", N.norm_event_time("raw").alias("parsed"))


def q_normalize_for_table(spark, sf):
    return N.to_relational(FX.txe(spark, sf).drop(COMMIT_TIME))


def q_reject_invalid_rows(spark, sf):
    _, rejected = R.valid_and_rejected(FX.txe(spark, sf).drop(COMMIT_TIME), limits=REJECT_LIMITS)
    return rejected.select("parcel_id", "transaction_id", "area",
                           F.col("_reject_reason").alias("reason"))


def q_batch_report(spark, sf):
    t = FX.txe(spark, sf).withColumn("_batch_id", (F.col("kafka_offset") % 5).cast("long"))
    return R.batch_report(R.prepare_batch(t, limits=REJECT_LIMITS))


# ---------------------------------------------------------------- versioned reads (pure)
# The reads reduce the batch log (TXE, one batch per commit) directly: a
# per-commit precombine followed by the per-key reduction gives the same rows
# as one reduction ordered by (commit, precombine, tie) -- or (precombine,
# commit, tie) under event-time merging -- so one shuffle does both.
def q_precombine_dedup(spark, sf):
    return _pre(spark, sf).select(*TXN_OUT)


def q_snapshot_read(spark, sf):
    return V.snapshot(FX.txe(spark, sf)).select(*TXN_OUT)


def q_snapshot_event_time(spark, sf):
    return V.snapshot(FX.txe(spark, sf), merge_mode="event_time").select(*TXN_OUT)


def q_time_travel_read(spark, sf):
    return V.snapshot(FX.txe(spark, sf), as_of="002").select(*TXN_OUT)


def q_incremental_read(spark, sf):
    return V.incremental(FX.txe(spark, sf), "001", "003").select(*TXN_OUT)


def q_incremental_read_open(spark, sf):
    return V.incremental(FX.txe(spark, sf), "001").select(*TXN_OUT)


# ---------------------------------------------------------------- versioned writes (path table)
def _fill(table: LakeTable, src: DataFrame, commits=FX.TXE_COMMITS) -> LakeTable:
    for c, b in _batches(src, commits):
        table.upsert(b, commit=c)
    return table


def q_cow_upsert(spark, sf):
    t = _fill(_lake(spark, "cow", table_type="cow"), FX.txe(spark, sf))
    return t.snapshot().select(*TXN_OUT)


def q_mor_upsert(spark, sf):
    t = _fill(_lake(spark, "mor", table_type="mor"), FX.txe(spark, sf))
    return t.snapshot().select(*TXN_OUT)


def _null_area_table(spark, sf, name, **kw) -> DataFrame:
    t = _fill(_lake(spark, name, **kw), FX.txe_null_areas(spark, sf))
    return t.snapshot().select(*TXN_OUT)


def q_cow_upsert_null_area(spark, sf):
    return _null_area_table(spark, sf, "cow-null", table_type="cow")


def q_mor_upsert_null_area(spark, sf):
    return _null_area_table(spark, sf, "mor-null", table_type="mor")


def q_wide_table_upsert(spark, sf):
    """The same rows where the manifest is too large to broadcast: reads join it by sorting."""
    return _null_area_table(spark, sf, "wide", table_type="cow", join_hint="merge")


def q_backfill_then_stream(spark, sf):
    """Commits 000 to 002 by batch writes, the rest of the same table by a stream."""
    t = _fill(_lake(spark, "backfill", table_type="cow"), FX.txe(spark, sf), FX.TXE_COMMITS[:3])
    src, ckpt = scratch_path(spark, "backfill-src"), scratch_path(spark, "backfill-ckpt")
    env = FX.env(spark, sf)  # messages without a key are all of batch 0
    for b in (3, 4):
        env.filter(F.col("offset") % 5 == b).write.mode("append").parquet(src)
        stream = P.parse_transactions(file_stream(spark, src, ENVELOPE_SCHEMA), layout="table")
        RUN.drain(stream.writeStream.foreachBatch(SK.lake_sink(t, stream=ckpt)), ckpt)
    return t.snapshot().select(*TXN_OUT)


def q_key_lookup(spark, sf):
    """Current rows of a few parcels of a merge-on-read table."""
    t = _fill(_lake(spark, "lookup", table_type="mor"), FX.txe(spark, sf))
    return t.lookup("7", "11", "13", "no such parcel").select(*TXN_OUT)


def q_packed_append(spark, sf):
    """Five batches appended to a table of files of 256 KB; underfull ones are topped up by each batch."""
    path = scratch_path(spark, "packed")
    for c, b in _batches(FX.txe(spark, sf)):
        PK.append_packed(b.withColumn(COMMIT_TIME, F.lit(c)), path, target=256 << 10, small=192 << 10)
    return PK.read_packed(spark, path).select(*TXN_OUT)


# ---------------------------------------------------------------- table-backed reads
def _both_kinds(spark, sf, name, read) -> DataFrame:
    """``read`` of a copy-on-write table, and of a merge-on-read table that was compacted
    on the way and cleaned down to four commits."""
    cow = _fill(_lake(spark, f"{name}-cow", table_type="cow"), FX.txe(spark, sf))
    mor = _mor_compacted_at_001(spark, sf)
    mor.clean(4)
    pick = lambda t, kind: read(t).select(F.lit(kind).alias("table_type"), *TXN_OUT)
    return pick(cow, "cow").unionByName(pick(mor, "mor"))


def q_table_snapshot(spark, sf):
    return _both_kinds(spark, sf, "read-snapshot", lambda t: t.snapshot())


def q_table_time_travel(spark, sf):
    return _both_kinds(spark, sf, "read-travel", lambda t: t.snapshot("002"))


def q_table_incremental(spark, sf):
    return _both_kinds(spark, sf, "read-incremental", lambda t: t.incremental("001", "003"))


def q_table_incremental_open(spark, sf):
    return _both_kinds(spark, sf, "read-open", lambda t: t.incremental("001"))


def q_history_after_compaction(spark, sf):
    t = _fill(_lake(spark, "history", table_type="mor"), FX.txe(spark, sf))
    t.compact()
    return t.history().select(*TXN_OUT)


def _mor_compacted_at_001(spark, sf) -> LakeTable:
    t = _lake(spark, "mor-ro", table_type="mor")
    src = FX.txe(spark, sf)
    _fill(t, src, FX.TXE_COMMITS[:2])
    t.compact("001")
    return _fill(t, src, FX.TXE_COMMITS[2:])


def q_read_optimized(spark, sf):
    return _mor_compacted_at_001(spark, sf).read_optimized().select(*TXN_OUT)


def q_compact_then_read_optimized(spark, sf):
    t = _mor_compacted_at_001(spark, sf)
    t.compact()
    return t.read_optimized().select(*TXN_OUT)


def q_retain_history(spark, sf):
    t = _fill(_lake(spark, "retain", table_type="mor"), FX.txe(spark, sf))
    t.clean(2)
    return t.history().select(*TXN_OUT)


def q_schema_reconcile(spark, sf):
    src = FX.txe(spark, sf).join(FX.table(spark, sf, "events").select(
        F.col("event_id").alias("kafka_offset"), "props"), "kafka_offset")
    t = _lake(spark, "reconcile", table_type="cow")
    for c, b in _batches(src):
        if c >= "003":  # later batches lose one column and bring a new one
            b = b.drop("transactionAmount")
        else:
            b = b.drop("props")
        t.upsert(b, commit=c)
    return t.snapshot().select(*TXN_OUT, "props")


def _txo_table(spark, sf, name) -> tuple[LakeTable, DataFrame]:
    t = _lake(spark, name, table_type="cow", keys=("area", "transactionId"),
              record_key=("transactionId",))
    return t, FX.txo(spark, sf).drop(COMMIT_TIME)


def q_partitioned_write(spark, sf):
    t, src = _txo_table(spark, sf, "partitioned")
    t.upsert(src, commit="001")
    return t.snapshot().select(*TRANSACTION_COLUMNS)


def q_overwrite_roundtrip(spark, sf):
    t, src = _txo_table(spark, sf, "overwrite")
    t.upsert(src, commit="001")
    t.overwrite(src, commit="002")
    return t.snapshot().select(*TRANSACTION_COLUMNS, COMMIT_TIME)


def q_table_metadata_columns(spark, sf):
    t = _fill(_lake(spark, "meta", table_type="cow"), FX.txe(spark, sf))
    return t.snapshot().select(COMMIT_TIME, "_record_key", "_partition_path", "parcelId", "area")


# ---------------------------------------------------------------- reports (TXO)
def q_latest_records_report(spark, sf):
    return REP.latest_records(_txo_snapshot(spark, sf))


def q_snapshot_count(spark, sf):
    return REP.snapshot_count(_txo_snapshot(spark, sf))


def q_area_breakdown(spark, sf):
    return REP.area_breakdown(V.snapshot(FX.txo_null_amounts(spark, sf)))


def q_type_breakdown(spark, sf):
    return REP.type_breakdown(_txo_snapshot(spark, sf))


def q_commit_timeline(spark, sf):
    return REP.commit_timeline(_txo_snapshot(spark, sf))


def q_commit_history(spark, sf):
    return REP.commit_history(_txo_snapshot(spark, sf))


def q_nth_commit(spark, sf):
    return REP.nth_commits(_txo_snapshot(spark, sf))


def q_ingest_snapshot_report(spark, sf):
    """ENV -> parse -> snapshot -> area report.

    Precombine-per-commit followed by the snapshot equals one reduction
    ordered by (commit, precombine, tie), so the raw parsed log goes
    straight into the snapshot: one shuffle instead of two.
    """
    parsed = P.parse_transactions(FX.env(spark, sf), layout="table")
    parsed = parsed.withColumn(COMMIT_TIME, F.lpad((F.col("kafka_offset") % 5).cast("string"), 3, "0"))
    return REP.area_breakdown(V.snapshot(parsed))


# ---------------------------------------------------------------- relational
def _relational_state(spark, sf, batches) -> BK.BucketedState:
    t = FX.txe(spark, sf).withColumn("_batch_id", (F.col("kafka_offset") % 5).cast("long"))
    valid, _ = R.valid_and_rejected(t.drop(COMMIT_TIME))
    path = scratch_path(spark, "relational")
    kept = BK.BucketedState(spark, "relational_" + path[-12:], path, buckets=BUCKETS)
    for batch in batches:
        kept.append(valid.filter(F.col("_batch_id") == batch))
    return kept


def q_relational_upsert(spark, sf):
    """Five batches applied one after the other, the last arrival of a parcel winning."""
    return _relational_state(spark, sf, range(5)).state().select(*REL_OUT)


def q_relational_fold(spark, sf):
    """The same, the log folded to the state after four batches; the last batch is replayed."""
    kept = _relational_state(spark, sf, range(4))
    kept.fold()
    t = FX.txe(spark, sf).withColumn("_batch_id", (F.col("kafka_offset") % 5).cast("long"))
    valid, _ = R.valid_and_rejected(t.drop(COMMIT_TIME))
    for _ in range(2):
        kept.append(valid.filter(F.col("_batch_id") == 4))
    return kept.state().select(*REL_OUT)


# ---------------------------------------------------------------- streaming
def q_stream_batch_report(spark, sf):
    """What the running relational sink keeps of each micro-batch: rows in, written, rejected."""
    t = _lake(spark, "report-rel", table_type="mor", keys=("parcel_id",), partition=None,
              record_key=("parcel_id",), precombine=R.TABLE_ORDER, tie=())
    rejected, reports = scratch_path(spark, "report-rejected"), scratch_path(spark, "reports")
    sink = lambda: SK.relational_sink(t, limits=REJECT_LIMITS, rejected_path=rejected, report_path=reports)
    _env_files_stream(spark, sf, sink, "report-rel")
    return spark.read.parquet(reports).select("batch_id", "rows_in", "rows_written", "rows_rejected", "keys_upserted")


def _env_files_stream(spark, sf, sink_factory, name):
    """ENV split by commit into 5 file drops; each drop is one availableNow
    run of the same query (batch ids 0..4), then one restart with nothing new."""
    src = scratch_path(spark, f"{name}-src")
    ckpt = scratch_path(spark, f"{name}-ckpt")
    env = FX.env(spark, sf)
    sink = sink_factory()
    runs = []
    for b in range(5):
        env.filter(F.col("offset") % 5 == b).write.mode("append").parquet(src)
        stream = P.parse_transactions(file_stream(spark, src, ENVELOPE_SCHEMA), layout="table")
        q = RUN.drain(stream.writeStream.foreachBatch(sink), ckpt)
        runs.append(RUN.batches_run(q))
    stream = P.parse_transactions(file_stream(spark, src, ENVELOPE_SCHEMA), layout="table")
    again = RUN.batches_run(RUN.drain(stream.writeStream.foreachBatch(sink), ckpt))
    return runs, again


def q_stream_upsert_table(spark, sf):
    t = _lake(spark, "stream-table", table_type="cow")
    _env_files_stream(spark, sf, lambda: SK.lake_sink(t, width=3), "stream-table")
    return t.snapshot().select(*TXN_OUT)


def q_stream_resume(spark, sf):
    t = _lake(spark, "stream-resume", table_type="mor")
    runs, again = _env_files_stream(spark, sf, lambda: SK.lake_sink(t, width=3), "stream-resume")
    if runs != [1, 1, 1, 1, 1] or again != 0:
        raise AssertionError(f"unexpected micro-batches: {runs} then {again}")
    return t.snapshot().select(*TXN_OUT)


def q_stream_relational_upsert(spark, sf):
    # merge-on-read: each micro-batch is a cheap delta; reads merge dirty groups
    t = _lake(spark, "stream-rel", table_type="mor", keys=("parcel_id",), partition=None,
              record_key=("parcel_id",), precombine=R.TABLE_ORDER, tie=())
    _env_files_stream(spark, sf, lambda: SK.relational_sink(t, width=3), "stream-rel")
    return t.snapshot().select(*REL_OUT)


def q_stream_file_passthrough(spark, sf):
    out = scratch_path(spark, "passthrough-out")
    ckpt = scratch_path(spark, "passthrough-ckpt")
    stream = FX.events_as_transactions(_events_stream(spark, sf))
    RUN.drain(SK.parquet_sink(stream, out), ckpt)
    return spark.read.parquet(out).select(*TXN_OUT)


def _window_stream(spark, sf, mode: str) -> DataFrame:
    out = scratch_path(spark, f"window-{mode}")
    ckpt = scratch_path(spark, f"window-{mode}-ckpt")
    ev = _events_stream(spark, sf)
    if mode == "complete":
        agg = WIN.window_counts(ev, "ts", "event_type")
    else:
        agg = WIN.watermarked_window_counts(WIN.event_time(ev, "ts"), "ts", "event_type")

    def write(df, batch_id):
        # a replayed batch overwrites its own folder; a complete result replaces all
        target = out if mode == "complete" else f"{out}/_batch_id={batch_id}"
        WIN.flatten_window(df).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(target)

    RUN.drain(agg.writeStream.foreachBatch(write), ckpt, output_mode=mode)
    res = spark.read.parquet(out)
    if mode == "update":  # a window may be re-emitted; keep its latest count
        res = V.latest_per_group(res, ["window_start", "area"], [F.col("_batch_id").desc()])
    return res.select("window_start", "window_end", "area", "count")


def q_windowed_area_count(spark, sf):
    return _window_stream(spark, sf, "complete")


def q_stream_window_append(spark, sf):
    return _window_stream(spark, sf, "append")


def q_stream_window_update(spark, sf):
    return _window_stream(spark, sf, "update")


def q_stream_stream_join(spark, sf):
    out = scratch_path(spark, "join-out")
    ckpt = scratch_path(spark, "join-ckpt")
    ev = WIN.event_time(_events_stream(spark, sf), "ts")
    s = ev.filter(F.col("event_type") == "signup").select("user_id", F.col("event_id").alias("signup_id"),
                                                          F.col("ts").alias("signup_ts"))
    p = ev.filter(F.col("event_type") == "purchase").select("user_id", F.col("event_id").alias("purchase_id"),
                                                            F.col("ts").alias("purchase_ts"))
    j = WIN.interval_join(s, p, "user_id", "signup_ts", "purchase_ts")
    res = j.select(F.col("l.user_id").alias("user_id"), "signup_id", "purchase_id",
                   F.col("signup_ts").cast("timestamp_ntz").alias("signup_ts"),
                   F.col("purchase_ts").cast("timestamp_ntz").alias("purchase_ts"))
    RUN.drain(SK.parquet_sink(res, out), ckpt)
    return spark.read.parquet(out)


def q_kafka_encode(spark, sf):
    enc = P.encode_messages(FX.txe(spark, sf).select(*TRANSACTION_COLUMNS))
    return enc.select(P.parse_json(F.col("value"), TRANSACTION_SCHEMA).alias("t")).select("t.*")


# ---------------------------------------------------------------- documents
def q_document_uri(spark, sf):
    return D.document_rows(FX.table(spark, sf, "documents"), DOCUMENT_ROOT)


def _staged_documents(spark, sf, name, docs=None) -> str:
    root = scratch_path(spark, name)
    D.stage_documents(FX.table(spark, sf, "documents") if docs is None else docs, root)
    return root


def _stored(spark, sf, name, docs=None) -> DataFrame:
    return D.document_ingest(spark, _staged_documents(spark, sf, f"{name}-staged", docs),
                             scratch_path(spark, f"{name}-store"), DOCUMENT_ROOT)


def q_document_new_only(spark, sf):
    docs = FX.table(spark, sf, "documents")
    incoming = D.document_rows(docs, DOCUMENT_ROOT)
    return D.new_only(incoming, _stored(spark, sf, "docs", docs.filter(F.col("lang") == "en"))).select(
        "doc_id", "parcel_id", "file_name")


def q_document_inventory(spark, sf):
    return D.document_inventory(spark, _staged_documents(spark, sf, "docs-inv")).select(
        "parcel_id", "file_name", "length")


def q_document_ingest(spark, sf):
    """All documents, ingested twice: the second time adds nothing."""
    staged, store = _staged_documents(spark, sf, "docs-twice"), scratch_path(spark, "docs-twice-store")
    D.document_ingest(spark, staged, store, DOCUMENT_ROOT)
    return D.document_ingest(spark, staged, store, DOCUMENT_ROOT).select(
        "parcel_id", "file_name", "length", "sha2", "uri")


def _chunked(spark, sf, name, chunk_bytes) -> tuple[str, DataFrame]:
    root, store = _staged_documents(spark, sf, f"{name}-staged"), scratch_path(spark, f"{name}-store")
    for files in (D.listed_files, D.manifest_files):  # the second time nothing is new
        stored = CH.ingest_chunks(spark, files(spark, root), store, DOCUMENT_ROOT, chunk_bytes=chunk_bytes)
    return store, stored


def q_document_chunk_ingest(spark, sf):
    """All documents in chunks of 1,000 bytes, ingested from a listing and again from the manifest."""
    return _chunked(spark, sf, "chunks", 1000)[1]


def q_document_restore(spark, sf):
    """Chunked documents written back as files, and those files read whole."""
    root = scratch_path(spark, "restored")
    CH.restore(spark, _chunked(spark, sf, "restore", 777)[0], root)
    return D.document_digests(spark, root)


def q_document_manifest(spark, sf):
    """The inventory without a listing."""
    return D.manifest_inventory(spark, _staged_documents(spark, sf, "docs-manifest"))


def q_document_reconcile(spark, sf):
    """Files staged without their manifest: a manifest of the English ones against the listing."""
    docs = FX.table(spark, sf, "documents")
    root = _staged_documents(spark, sf, "docs-reconcile")
    listed = _staged_documents(spark, sf, "docs-english", docs.filter(F.col("lang") == "en"))
    return D.reconcile(D.manifest_inventory(spark, listed), D.listed_files(spark, root).drop("path"))


def q_storage_inventory(spark, sf):
    return D.storage_inventory(spark, _staged_documents(spark, sf, "storage")).select(
        "file_name", "file_class", "size_kb")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}
