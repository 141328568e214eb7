"""Running streaming queries: triggers, checkpoints, drain-and-stop."""

from __future__ import annotations

from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

# --- fixed values: processing-time triggers of the three pipelines
TRIGGER_CONSOLE = "10 seconds"
TRIGGER_RELATIONAL = "15 seconds"
TRIGGER_TABLE = "30 seconds"


def start(writer: DataStreamWriter, checkpoint: str, trigger: str | None = None,
          available_now: bool = False, output_mode: str = "append",
          query_name: str | None = None) -> StreamingQuery:
    """Start with an explicit checkpoint (offsets and state survive restarts;
    ``startingOffsets`` only applies to a fresh checkpoint)."""
    w = writer.option("checkpointLocation", checkpoint).outputMode(output_mode)
    if query_name:
        w = w.queryName(query_name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger:
        w = w.trigger(processingTime=trigger)
    return w.start()


def drain(writer: DataStreamWriter, checkpoint: str, output_mode: str = "append",
          timeout_s: float | None = None) -> StreamingQuery:
    """Process everything available now, then stop (run-once trigger)."""
    q = start(writer, checkpoint, available_now=True, output_mode=output_mode)
    q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError(f"stream did not drain within {timeout_s}s")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q


def batches_run(q: StreamingQuery) -> int:
    """Micro-batches that read input during this run."""
    return sum(1 for p in q.recentProgress if (p.get("numInputRows") or 0) > 0)
