"""Event-time windows, watermarks and the stream-stream interval join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def event_time(df: DataFrame, ts: str, out: str | None = None) -> DataFrame:
    """Watermarks need ``timestamp`` (not text, not ``timestamp_ntz``)."""
    return df.withColumn(out or ts, F.col(ts).cast("timestamp"))


def window_counts(df: DataFrame, ts: str, group: str, duration: str = "5 minutes",
                  alias: str = "area") -> DataFrame:
    """Tumbling-window count per group (5 minutes by area by default)."""
    return (df.groupBy(F.window(ts, duration).alias("w"), F.col(group).alias(alias))
              .agg(F.count(F.lit(1)).alias("count")))


def watermarked_window_counts(df: DataFrame, ts: str, group: str, duration: str = "5 minutes",
                              delay: str = "10 minutes", alias: str = "area") -> DataFrame:
    """Same, tolerating ``delay`` of lateness; older rows are dropped and
    windows are final once the watermark passes their end."""
    return window_counts(df.withWatermark(ts, delay), ts, group, duration, alias)


def flatten_window(df: DataFrame) -> DataFrame:
    """``window`` struct -> ``window_start, window_end`` as timestamp_ntz."""
    rest = [c for c in df.columns if c != "w"]
    return df.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                     F.col("w.end").cast("timestamp_ntz").alias("window_end"), *rest)


def interval_join(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
                  within: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Inner join of two streams on ``key`` with ``right_ts`` in
    ``[left_ts, left_ts + within]``; watermarks bound the join state."""
    l = left.withWatermark(left_ts, delay).alias("l")
    r = right.withWatermark(right_ts, delay).alias("r")
    cond = ((F.col(f"l.{key}") == F.col(f"r.{key}"))
            & (F.col(f"r.{right_ts}") >= F.col(f"l.{left_ts}"))
            & (F.col(f"r.{right_ts}") <= F.col(f"l.{left_ts}") + F.expr(f"INTERVAL {within}")))
    return l.join(r, cond, "inner")
