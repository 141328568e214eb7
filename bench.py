"""Headline benchmark: prints ONE JSON line.

Times (warm, median of ``BENCH_REPS``, default 3) at ``$BENCH_SF_DIR``
(default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]``:

* precombine / snapshot / as_of / incremental (pure reductions of the TXE batch log)
* cow_upsert / mor_upsert: one more commit into a 4-commit table
* snapshot_cow / snapshot_mor / read_optimized / compaction / read_after_compaction
* cow_upsert_next: the same batch as ever further commits of a growing table
* relational_upsert (state after 5 batches, last arrival wins), relational_batch (one batch appended to
  a bucketed state), relational_state (its read)
* windowed_count (5-minute windows by area, streaming, complete mode), windowed_append (the same,
  watermarked, append mode)
* area_report (ENV -> parse -> precombine -> snapshot -> area summary)

Results are forced with the ``noop`` sink (full computation, no collect).
Ratios for the reference's qualitative claims are reported under ``claims``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from keyedlake.operators import versioned as V  # noqa: E402
from keyedlake.plans import catalog as C  # noqa: E402
from keyedlake.plans import fixtures as FX  # noqa: E402
from keyedlake.schema import COMMIT_TIME  # noqa: E402
from keyedlake.session import build_session, scratch_path  # noqa: E402
from keyedlake.sources.lake import LakeTable  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPS = int(os.environ.get("BENCH_REPS", "3"))


def force(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, reps: int = REPS, warm: bool = True) -> float:
    if warm:
        fn()
    ts = []
    for _ in range(reps):
        t0 = time.perf_counter()
        fn()
        ts.append(time.perf_counter() - t0)
    return round(statistics.median(ts), 3)


def main() -> None:
    spark = build_session(f"local[{CPUS}]", app="keyedlake-bench",
                          shuffle_partitions=int(CPUS) * 2,
                          spark__driver__memory="16g")
    sf = SF_DIR
    out: dict[str, float] = {}

    txe = FX.txe(spark, sf)
    out["precombine"] = timed(lambda: force(V.precombine(txe, within=[COMMIT_TIME])))
    out["snapshot"] = timed(lambda: force(V.snapshot(txe)))
    out["as_of"] = timed(lambda: force(V.snapshot(txe, as_of="002")))
    out["incremental"] = timed(lambda: force(V.incremental(txe, "001", "003")))

    tables = {}
    for kind in ("cow", "mor"):
        t = LakeTable(spark, scratch_path(spark, f"bench-{kind}"), table_type=kind, buckets=C.BUCKETS)
        for c, b in C._batches(txe, FX.TXE_COMMITS[:4]):
            t.upsert(b, commit=c)
        tables[kind] = t
    last = txe.filter(F.col(COMMIT_TIME) == "004").drop(COMMIT_TIME)
    # replaying commit 004 redoes the same write each time (idempotent)
    out["cow_upsert"] = timed(lambda: tables["cow"].upsert(last, commit="004"))
    out["mor_upsert"] = timed(lambda: tables["mor"].upsert(last, commit="004"))
    out["snapshot_cow"] = timed(lambda: force(tables["cow"].snapshot()))
    out["snapshot_mor"] = timed(lambda: force(tables["mor"].snapshot()))
    out["read_optimized"] = timed(lambda: force(tables["mor"].read_optimized()))
    # compaction changes the table, so it is timed once (the JVM is warm by now)
    out["compaction"] = timed(lambda: tables["mor"].compact("004"), reps=1, warm=False)
    out["read_after_compaction"] = timed(lambda: force(tables["mor"].snapshot()))

    # further commits: the manifest and the number of stored slots grow with each
    after = iter(range(5, 100))
    out["cow_upsert_next"] = timed(lambda: tables["cow"].upsert(last, commit=f"{next(after):03d}"))

    out["relational_upsert"] = timed(lambda: force(C.q_relational_upsert(spark, sf)))
    kept = C._relational_state(spark, sf, range(4))
    arrived = kept.log().limit(0).unionByName(kept.state().withColumn("_batch_id", F.lit(4).cast("long")))
    out["relational_batch"] = timed(lambda: kept.append(arrived), reps=1, warm=False)
    out["relational_state"] = timed(lambda: force(kept.state()))
    out["windowed_count"] = timed(lambda: force(C.q_windowed_area_count(spark, sf)))
    out["windowed_append"] = timed(lambda: force(C.q_stream_window_append(spark, sf)))
    out["area_report"] = timed(lambda: force(C.q_ingest_snapshot_report(spark, sf)))

    claims = {
        "cow_over_mor_write": round(out["cow_upsert"] / max(out["mor_upsert"], 1e-9), 3),
        "mor_over_cow_snapshot": round(out["snapshot_mor"] / max(out["snapshot_cow"], 1e-9), 3),
        "read_optimized_over_mor_snapshot": round(out["read_optimized"] / max(out["snapshot_mor"], 1e-9), 3),
        "after_compaction_over_cow_snapshot": round(out["read_after_compaction"] / max(out["snapshot_cow"], 1e-9), 3),
    }
    print(json.dumps({
        "metric": "headline_total_sec",
        "value": round(sum(out.values()), 3),
        "unit": "sec",
        "queries": out,
        "claims": claims,
        "sf": os.path.basename(sf.rstrip("/")).replace("sf", ""),
        "cpus": int(CPUS),
        "reps": REPS,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
