"""Late rows and the lifetime of queries, observed."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from keyedlake.streaming import runner as RUN
from keyedlake.streaming import windows as WIN
from keyedlake.streaming.progress import ProgressLog


def at(minutes):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minutes)


def test_late_rows_are_counted(spark, tmp_table):
    src, ckpt, out = tmp_table("late-src"), tmp_table("late-ckpt"), tmp_table("late-out")
    schema = "ts timestamp, area string"
    drops = [[(at(0), "a"), (at(120), "a")], [(at(121), "a")],
             [(at(1), "a"), (at(12), "b"), (at(122), "b")]]  # two rows of windows that ended before the watermark
    with ProgressLog(spark) as log:
        for rows in drops:
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
            stream = spark.readStream.schema(schema).parquet(src)
            counts = WIN.watermarked_window_counts(WIN.event_time(stream, "ts"), "ts", "area")
            q = RUN.drain(counts.writeStream.foreachBatch(lambda df, i: df.write.mode("append").parquet(out)), ckpt)
            log.wait(q.runId)
        seen = log.table()
        assert seen.filter("event = 'progress'").agg(F.sum("dropped_late"), F.sum("input_rows")).first() == (2, 6)
        assert seen.filter("event = 'started'").count() == seen.filter("event = 'terminated'").count() == 3
        assert seen.filter("event = 'terminated' and error is not null").count() == 0
        kept, n = tmp_table("late-log"), seen.count()
        log.flush(kept)
        log.flush(kept)
        assert spark.read.parquet(kept).count() == n and log.table().count() == 0


def test_failures_are_recorded(spark, tmp_table):
    src = tmp_table("fail-src")
    spark.range(3).write.parquet(src)

    def fail(df, batch_id):
        raise RuntimeError("no room")

    with ProgressLog(spark) as log:
        q = RUN.start(spark.readStream.schema("id long").parquet(src).writeStream.foreachBatch(fail), tmp_table("fail-ckpt"),
                      available_now=True)
        with pytest.raises(Exception, match="no room"):
            q.awaitTermination(60)
        log.wait(q.runId)
        assert "no room" in log.table().filter("event = 'terminated'").first().error
