from pyspark.sql import functions as F

from keyedlake.plans import fixtures as FX
from keyedlake.sources.files import file_stream
from keyedlake.streaming import runner as RUN
from keyedlake.streaming import windows as WIN

SF = "/root/testdata/sf0.001"


def test_watermark_drops_late_rows(spark, tmp_table):
    ev = FX.table(spark, SF, "events")
    src, out, ckpt = tmp_table("wm-src"), tmp_table("wm-out"), tmp_table("wm-ckpt")
    late_half = ev.filter(F.col("event_id") < 500)
    ev.filter(F.col("event_id") >= 500).write.parquet(src)        # batch 0: the later half
    stream = WIN.watermarked_window_counts(WIN.event_time(file_stream(spark, src, ev.schema), "ts"),
                                           "ts", "event_type")

    def sink(df, batch_id):
        WIN.flatten_window(df).write.mode("append").parquet(out)

    q = RUN.drain(stream.writeStream.foreachBatch(sink), ckpt)
    late_half.write.mode("append").parquet(src)                    # batch 1: every row is late
    q = RUN.drain(stream.writeStream.foreachBatch(sink), ckpt)
    res = spark.read.parquet(out)
    assert res.agg(F.sum("count")).first()[0] <= 500
    first_late = late_half.agg(F.max("ts")).first()[0]
    assert res.filter(F.col("window_end") <= first_late).count() == 0
    assert any((p.get("stateOperators") or [{}])[0].get("numRowsDroppedByWatermark", 0) > 0
               for p in q.recentProgress)


def test_resume_runs_no_new_batch(spark, tmp_table):
    ev = FX.table(spark, SF, "events")
    src, out, ckpt = tmp_table("rs-src"), tmp_table("rs-out"), tmp_table("rs-ckpt")
    ev.write.parquet(src)
    stream = FX.events_as_transactions(file_stream(spark, src, ev.schema))
    q1 = RUN.drain(stream.writeStream.format("parquet").option("path", out), ckpt)
    q2 = RUN.drain(stream.writeStream.format("parquet").option("path", out), ckpt)
    assert RUN.batches_run(q1) == 1 and RUN.batches_run(q2) == 0
    assert spark.read.parquet(out).count() == 1000


def test_console_sink_with_processing_time_trigger(spark, tmp_table):
    from keyedlake.streaming import sinks as SK
    ev = FX.table(spark, SF, "events")
    src = tmp_table("console-src")
    ev.limit(5).write.parquet(src)
    q = RUN.start(SK.console(file_stream(spark, src, ev.schema), num_rows=50), tmp_table("console-ckpt"),
                  trigger=RUN.TRIGGER_CONSOLE)
    try:
        q.processAllAvailable()
        assert RUN.batches_run(q) == 1
    finally:
        q.stop()


def test_entry_point_jobs(spark, tmp_table):
    from keyedlake.operators import versioned as V
    from keyedlake.plans import catalog as C
    from keyedlake.schema import ENVELOPE_SCHEMA
    from keyedlake.sources.lake import LakeTable
    from keyedlake.streaming import jobs as J
    src = tmp_table("jobs-src")
    FX.env(spark, SF).write.parquet(src)
    envelope = file_stream(spark, src, ENVELOPE_SCHEMA)
    lake = LakeTable(spark, tmp_table("jobs-lake"), buckets=2)
    q = J.table_ingest(envelope, lake, tmp_table("jobs-ckpt1"), available_now=True)
    q.awaitTermination(600)
    rel = LakeTable(spark, tmp_table("jobs-rel"), table_type="mor", keys=("parcel_id",), partition=None,
                    record_key=("parcel_id",), precombine=("kafka_partition", "kafka_offset"), tie=(), buckets=2)
    q2 = J.relational_ingest(envelope, tmp_table("jobs-ckpt2"), table=rel, available_now=True)
    q2.awaitTermination(600)
    keyed = FX.txe(spark, SF).filter(F.col("kafka_offset") % 10 != 0)
    # one micro-batch, one commit: the snapshot is the precombined batch
    want = sorted(map(tuple, V.precombine(keyed).select(*C.TXN_OUT[:-1]).collect()))
    assert sorted(map(tuple, lake.snapshot().select(*C.TXN_OUT[:-1]).collect())) == want
    assert rel.snapshot().count() == keyed.select("parcelId").distinct().count()
    q3 = J.console_ingest(envelope, tmp_table("jobs-ckpt3"), available_now=True)
    q3.awaitTermination(600)
    assert RUN.batches_run(q3) == 1


def test_a_replayed_window_batch_adds_nothing(spark, monkeypatch):
    """Each batch of the windowed append is written twice, as after a crash."""
    from pyspark.sql.streaming import DataStreamWriter

    from keyedlake.plans import catalog as C
    want = sorted(map(tuple, C.q_stream_window_append(spark, SF).collect()))
    once = DataStreamWriter.foreachBatch
    monkeypatch.setattr(DataStreamWriter, "foreachBatch",
                        lambda self, body: once(self, lambda df, i: (body(df, i), body(df, i)) and None))
    assert sorted(map(tuple, C.q_stream_window_append(spark, SF).collect())) == want
