"""Path-backed lake table: the labs' written expectations as golden tests,
plus properties (CoW == MoR, idempotent replay, invisible partial commits,
compaction and retention keep as-of reads)."""

import pytest
from pyspark.sql import functions as F

from lab_rows import lab_batch

from keyedlake.plans import catalog as C
from keyedlake.plans import fixtures as FX
from keyedlake.plans import reports as REP
from keyedlake.sources.lake import LakeTable

SF = "/root/testdata/sf0.001"


def _status(df, col="validationStatus"):
    return {r.parcelId: r[col] for r in df.collect()}


@pytest.fixture(scope="module")
def lab12(spark):
    from keyedlake.session import scratch_path
    t = LakeTable(spark, scratch_path(spark, "test-golden12"), table_type="cow", buckets=2)
    sizes = []
    for i, c in enumerate(["001", "002", "003"]):
        t.upsert(lab_batch(spark, i), commit=c)
        sizes.append(t.snapshot().count())
    return t, sizes


def test_golden_cow_writes(lab12):
    t, sizes = lab12
    assert sizes == [5, 6, 7]  # "6, not 8" after batch 2
    s2 = t.snapshot("002")
    assert _status(s2)["PCL-MM-001"] == "VALID" and _status(s2)["PCL-QC-001"] == "INVALID"
    assert "PCL-TG-001" in _status(s2)
    commits = {r.parcelId: r._commit_time for r in s2.collect()}
    assert commits["PCL-MM-001"] > commits["PCL-MM-002"]  # untouched key keeps its commit


def test_golden_query_types(lab12):
    t, _ = lab12
    assert [r._commit_time for r in REP.commit_history(t.snapshot()).collect()] == ["001", "002", "003"]
    snap = t.snapshot()
    assert _status(snap)["PCL-BGC-001"] == "VALID"
    as1 = t.snapshot("001")
    assert as1.count() == 5 and set(_status(as1).values()) == {"PENDING"}
    as2 = t.snapshot("002")
    assert as2.count() == 6 and _status(as2)["PCL-BGC-001"] == "PENDING"
    inc = t.incremental("002", "003")
    assert sorted(_status(inc)) == ["PCL-BGC-001", "PCL-PS-001"]
    assert t.incremental("002").count() == 2
    timeline = {r._commit_time: r.records_in_commit for r in REP.commit_timeline(snap).collect()}
    assert timeline == {"001": 2, "002": 3, "003": 2}
    meta = t.snapshot().select("_record_key", "_partition_path", "parcelId", "area").collect()
    assert all(r._record_key == r.parcelId and r._partition_path == f"area={r.area}" for r in meta)


GOLDEN3 = "parcelId string, transactionId string, transactionType string, area string, " \
       "transactionAmount double, validationStatus string, transactionDate string"
GOLDEN3_INITIAL = [
    ("PCL-MM-001", "TXN-001", "PURCHASE", "Makati", 4500000.0, "PENDING", "2024-01-15T09:00:00"),
    ("PCL-MM-002", "TXN-002", "MORTGAGE", "Makati", 3200000.0, "PENDING", "2024-01-15T09:01:00"),
    ("PCL-QC-001", "TXN-003", "TRANSFER", "Quezon City", 2800000.0, "PENDING", "2024-01-15T09:02:00"),
    ("PCL-QC-002", "TXN-004", "PURCHASE", "Quezon City", 8100000.0, "PENDING", "2024-01-15T09:03:00"),
    ("PCL-BGC-001", "TXN-005", "LEASE", "BGC", 6500000.0, "PENDING", "2024-01-15T09:04:00"),
]


def test_golden_cow_vs_mor(spark, tmp_table):
    tables = {k: LakeTable(spark, tmp_table(f"golden3-{k}"), table_type=k, buckets=2) for k in ("cow", "mor")}
    for t in tables.values():
        t.overwrite(spark.createDataFrame(GOLDEN3_INITIAL, GOLDEN3), commit="000")
    for n in (1, 2, 3):
        upd = spark.createDataFrame([
            ("PCL-MM-001", "TXN-001", "PURCHASE", "Makati", 4500000.0, "VALID", f"2024-01-15T1{n}:00:00"),
            ("PCL-QC-001", "TXN-003", "TRANSFER", "Quezon City", 2800000.0, "INVALID", f"2024-01-15T1{n}:01:00"),
        ], GOLDEN3)
        for t in tables.values():
            t.upsert(upd, commit=f"00{n}")
    cow, mor = tables["cow"], tables["mor"]
    for t in (cow, mor):
        s = _status(t.snapshot())
        assert s["PCL-MM-001"] == "VALID" and s["PCL-QC-001"] == "INVALID" and len(s) == 5
    # read-optimised: stale base before compaction
    assert set(_status(mor.read_optimized()).values()) == {"PENDING"}
    # storage: copy-on-write has only base slices, merge-on-read base + 3 deltas
    cow_files = cow.storage().collect()
    mor_files = mor.storage().collect()
    writes = lambda files: {r.path.split("/_write=")[1].split("/")[0] for r in files if "/data/" in r.path}
    assert all(w.endswith(".b") for w in writes(cow_files))
    assert {w for w in writes(mor_files) if w.endswith(".d")} == {"001.d", "002.d", "003.d"}
    assert all(r.file_class == "PARQUET" for r in mor_files)
    before = sorted(map(tuple, mor.snapshot().collect()))
    assert mor.compact() == "003"
    assert sorted(map(tuple, mor.snapshot().collect())) == before  # snapshot unchanged
    ro = _status(mor.read_optimized())
    assert ro["PCL-MM-001"] == "VALID" and ro["PCL-QC-001"] == "INVALID"
    assert mor.compact() is None  # nothing left to fold


def test_setup_verifier_roundtrip(spark, tmp_table):
    t = LakeTable(spark, tmp_table("smoke"), keys=("transactionType", "parcelId"), partition="transactionType",
                  precombine=("transactionAmount",), tie=())
    df = spark.createDataFrame([("P1", "PURCHASE", 1.0), ("P2", "LEASE", 2.0)],
                               "parcelId string, transactionType string, transactionAmount double")
    t.overwrite(df, commit="001")
    got = sorted((r.parcelId, r.transactionType, r.transactionAmount) for r in t.snapshot().collect())
    assert got == [("P1", "PURCHASE", 1.0), ("P2", "LEASE", 2.0)]


def _sorted(df):
    return sorted(map(tuple, df.select(*C.TXN_OUT).collect()))


def test_cow_equals_mor_and_replay_is_idempotent(spark, tmp_table):
    txe = FX.txe(spark, SF)
    cow = C._fill(LakeTable(spark, tmp_table("p-cow"), table_type="cow", buckets=4), txe)
    mor = C._fill(LakeTable(spark, tmp_table("p-mor"), table_type="mor", buckets=4), txe)
    ref = _sorted(C.q_snapshot_read(spark, SF))
    assert _sorted(cow.snapshot()) == ref == _sorted(mor.snapshot())
    for c in ("000", "002", "004"):
        assert _sorted(cow.snapshot(c)) == _sorted(mor.snapshot(c))
    assert _sorted(cow.incremental("001", "003")) == _sorted(mor.incremental("001", "003"))
    # replaying the last batch id rewrites the same commit: nothing changes
    last = txe.filter(F.col("_commit_time") == "004").drop("_commit_time")
    cow.upsert(last, commit="004")
    mor.upsert(last, commit="004")
    assert _sorted(cow.snapshot()) == ref == _sorted(mor.snapshot())
    assert cow.commits() == FX.TXE_COMMITS


def test_partial_commit_is_invisible(spark, tmp_table):
    txe = FX.txe(spark, SF)
    t = C._fill(LakeTable(spark, tmp_table("partial"), table_type="mor", buckets=4), txe, FX.TXE_COMMITS[:3])
    before = _sorted(t.snapshot())
    # data of commit 003 lands but the writer dies before its manifest rows
    t._write_rows(t._stamp(txe.filter(F.col("_commit_time") == "003").drop("_commit_time"), "003"), "003", "d")
    assert _sorted(t.snapshot()) == before


def test_compaction_and_retention_keep_as_of(spark, tmp_table):
    txe = FX.txe(spark, SF)
    t = C._fill(LakeTable(spark, tmp_table("retain"), table_type="mor", buckets=4), txe)
    as_of = {c: _sorted(t.snapshot(c)) for c in ("003", "004")}
    t.compact("002")
    assert all(_sorted(t.snapshot(c)) == v for c, v in as_of.items())
    assert t.clean(2, purge=True) == "003"
    assert all(_sorted(t.snapshot(c)) == v for c, v in as_of.items())
    with pytest.raises(ValueError):
        t.snapshot("001")
    assert t.history().count() == C.q_retain_history(spark, SF).count()


def test_empty_batch_and_schema_reconcile(spark, tmp_table):
    t = LakeTable(spark, tmp_table("reconcile"), buckets=2)
    a = spark.createDataFrame([("P1", "A", "x", "2024-01-01T00:00:00", 1.0)],
                              "parcelId string, area string, transactionId string, transactionDate string, "
                              "transactionAmount double")
    t.upsert(a, commit="001")
    assert t.upsert(a.limit(0), commit="002") is None
    b = spark.createDataFrame([("P2", "A", "y", "2024-01-02T00:00:00", "web")],
                              "parcelId string, area string, transactionId string, transactionDate string, "
                              "channel string")
    t.upsert(b, commit="003")
    rows = {r.parcelId: (r.transactionAmount, r.channel) for r in t.snapshot().collect()}
    assert rows == {"P1": (1.0, None), "P2": (None, "web")}
    assert t.commits() == ["001", "003"]


def test_event_time_merge_mode(spark, tmp_table):
    t = LakeTable(spark, tmp_table("evt"), merge_mode="event_time", buckets=2)
    s = "parcelId string, area string, transactionId string, transactionDate string, v string"
    t.upsert(spark.createDataFrame([("P1", "A", "1", "2024-01-02T00:00:00", "newer")], s), commit="001")
    t.upsert(spark.createDataFrame([("P1", "A", "2", "2024-01-01T00:00:00", "late")], s), commit="002")
    assert [r.v for r in t.snapshot().collect()] == ["newer"]


def test_metadata_columns_with_file_names(spark, tmp_table):
    txe = FX.txe(spark, SF)
    t = C._fill(LakeTable(spark, tmp_table("files"), table_type="mor", buckets=4), txe, FX.TXE_COMMITS[:3])
    rows = t.snapshot(file_names=True).select("_commit_time", "_commit_seqno", "_file_name").collect()
    assert len(rows) == t.snapshot().count()
    assert all(r._file_name.endswith(".parquet") and r._commit_seqno.startswith(r._commit_time + "_")
               for r in rows)


def test_option_style_read_write(spark, tmp_table):
    from keyedlake.sources import options as O
    path = tmp_table("opts")
    opts = {"prefix.datasource.write.table.type": "MERGE_ON_READ", "recordkey.field": "parcelId",
            "partitionpath.field": "area", "precombine.field": "transactionDate"}
    for i, c in enumerate(["001", "002", "003"]):
        O.write(lab_batch(spark, i), path, mode="overwrite" if i == 0 else "append", commit=c, **opts)
    assert O.read(spark, path).count() == 7
    assert O.read(spark, path, **{"as.of.instant": "001"}).count() == 5
    inc = O.read(spark, path, **{"query.type": "incremental", "begin.instanttime": "002",
                                 "end.instanttime": "003"})
    assert sorted(r.parcelId for r in inc.collect()) == ["PCL-BGC-001", "PCL-PS-001"]
    ro = O.read(spark, path, **{"query.type": "read_optimized"})
    assert ro.count() == 5  # base is the first write; later commits are deltas
    assert LakeTable.open(spark, path).table_type == "mor"


def test_automatic_retention_is_amortised(spark, tmp_table):
    txe = FX.txe(spark, SF)
    t = LakeTable(spark, tmp_table("auto-retain"), table_type="mor", buckets=2, retain_commits=2)
    C._fill(t, txe)
    cleans = [a for a in t.timeline() if a.action == "clean"]
    assert len(cleans) == 1  # after commit 002 (3 > 2); the next fold waits for 4 more commits
    from keyedlake.operators import versioned as V
    for c in ("003", "004"):  # retained commits read exactly as before retention
        want = sorted(map(tuple, V.snapshot(txe, as_of=c).select(*C.TXN_OUT).collect()))
        assert sorted(map(tuple, t.snapshot(c).select(*C.TXN_OUT).collect())) == want
    ref = sorted(map(tuple, C.q_snapshot_read(spark, SF).collect()))
    assert sorted(map(tuple, t.snapshot().select(*C.TXN_OUT).collect())) == ref


def test_key_filters_reach_the_scan(spark, tmp_table):
    txe = FX.txe(spark, SF)
    t = C._fill(LakeTable(spark, tmp_table("push"), table_type="mor", buckets=4), txe)
    q = t.snapshot().filter((F.col("area") == "click") & (F.col("parcelId") == "7"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "3000")
    try:
        plan = q._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = [l for l in plan.split("\n") if "FileScan" in l]
    scans = [l for l in scans if "/data" in l]
    # the partition value is told by its directory, so the filter prunes directories, as the manifest does at run time
    assert scans
    for line in scans:
        pruned = line.split("PartitionFilters")[1].split("PushedFilters")[0]
        assert "_slot" in pruned and "click" in pruned and "dynamicpruning" in pruned
        assert "EqualTo(parcelId,7)" in line
    want = C.q_snapshot_read(spark, SF).filter((F.col("area") == "click") & (F.col("parcelId") == "7"))
    assert sorted(map(tuple, q.select(*C.TXN_OUT).collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("kind", ["cow", "mor"])
def test_reads_by_sorted_joins(spark, tmp_table, kind):
    """A manifest too large to broadcast: results must equal the small table's."""
    from keyedlake.operators import versioned as V
    txe = FX.txe(spark, SF)
    t = LakeTable(spark, tmp_table(f"wide-{kind}"), table_type=kind, buckets=4, join_hint="merge")
    C._fill(t, txe, FX.TXE_COMMITS[:3])
    if kind == "mor":
        t.compact("001")
    C._fill(t, txe, FX.TXE_COMMITS[3:])
    for c in ("001", "003", "004"):
        want = sorted(map(tuple, V.snapshot(txe, as_of=c).select(*C.TXN_OUT).collect()))
        assert sorted(map(tuple, t.snapshot(c).select(*C.TXN_OUT).collect())) == want
    want = sorted(map(tuple, V.incremental(txe, "001", "003").select(*C.TXN_OUT).collect()))
    assert sorted(map(tuple, t.incremental("001", "003").select(*C.TXN_OUT).collect())) == want
    if kind == "mor":
        assert t.compact() == "004"
        want = sorted(map(tuple, V.snapshot(txe).select(*C.TXN_OUT).collect()))
        assert sorted(map(tuple, t.read_optimized().select(*C.TXN_OUT).collect())) == want


def test_replay_with_fewer_groups(spark, tmp_table):
    """The replayed commit's old slots no longer count, those of other commits still do."""
    from keyedlake.operators import versioned as V
    txe = FX.txe(spark, SF)
    narrow = (F.col("_commit_time") < "004") | (F.col("area") == "click")
    for kind in ("cow", "mor"):
        t = C._fill(LakeTable(spark, tmp_table(f"replay-{kind}"), table_type=kind, buckets=4), txe)
        t.upsert(txe.filter((F.col("_commit_time") == "004") & narrow).drop("_commit_time"), commit="004")
        want = sorted(map(tuple, V.snapshot(txe.filter(narrow)).select(*C.TXN_OUT).collect()))
        assert sorted(map(tuple, t.snapshot().select(*C.TXN_OUT).collect())) == want
        assert t.manifest().filter("commit = '004' and kind > ''").select("_part").distinct().count() == 1


def test_manifest_tells_what_was_written(spark, tmp_table):
    txe = FX.txe(spark, SF)
    t = C._fill(LakeTable(spark, tmp_table("manifest"), table_type="mor", buckets=2), txe)
    t.compact()
    acts = [(r.commit, r.action) for r in t.timeline()]
    assert acts == [*((c, "deltacommit") for c in FX.TXE_COMMITS[:-1]), ("004", "compaction"), ("004", "deltacommit")]
    rows = {r.commit: r.rows for r in t.timeline() if r.action == "deltacommit"}
    sums = {r.commit: r.n for r in t.manifest().filter("action = 'deltacommit' and kind > ''").groupBy("commit")
            .agg(F.sum("rows").alias("n")).collect()}
    assert rows == sums == {r._commit_time: r["count"] for r in C._pre(spark, SF).groupBy("_commit_time").count().collect()}


def test_inline_compaction_schedule(spark, tmp_table):
    txe = FX.txe(spark, SF)
    t = C._fill(LakeTable(spark, tmp_table("auto-compact"), table_type="mor", buckets=2, compact_every=2), txe)
    compactions = [a.commit for a in t.timeline() if a.action == "compaction"]
    assert compactions == ["002", "004"]  # base at 000, deltas 001-002 folded, then 003-004
    ref = sorted(map(tuple, C.q_snapshot_read(spark, SF).collect()))
    assert sorted(map(tuple, t.read_optimized().select(*C.TXN_OUT).collect())) == ref


def test_upsert_reads_only_touched_groups(spark, tmp_table):
    """The rewrite's scan is pruned to the slots that the batch touches."""
    txe = FX.txe(spark, SF)
    t = C._fill(LakeTable(spark, tmp_table("narrow"), table_type="cow", buckets=4), txe, FX.TXE_COMMITS[:2])
    at, schema = t._at()
    touched = t._with_group(txe.filter("area = 'click'")).select("_part", "_bucket").distinct()
    read = t._read(at, schema, touched=touched, file_names=True).select("area", "_commit_time").distinct().collect()
    assert {r.area for r in read} == {"click"}
    spark.conf.set("spark.sql.maxMetadataStringLength", "3000")
    try:
        plan = t._read(at, schema, touched=touched)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = next(l for l in plan.split("\n") if "/data" in l)
    assert "dynamicpruning" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_merge_on_read_skips_deltas_folded_by_compaction(spark, tmp_table):
    from keyedlake.operators import versioned as V
    txe = FX.txe(spark, SF)
    t = LakeTable(spark, tmp_table("delta-skip"), table_type="mor", buckets=2)
    C._fill(t, txe, FX.TXE_COMMITS[:3])
    t.compact()
    C._fill(t, txe, FX.TXE_COMMITS[3:])
    deltas = lambda: {r.commit for r in t._slots("004").filter("kind = 'd'").collect()}
    assert deltas() == {"003", "004"}
    want = sorted(map(tuple, C.q_snapshot_read(spark, SF).collect()))
    assert sorted(map(tuple, t.snapshot().select(*C.TXN_OUT).collect())) == want
    t.compact()
    assert deltas() == set() and sorted(map(tuple, t.snapshot().select(*C.TXN_OUT).collect())) == want
    for as_of in ("001", "002"):  # reads before the compactions still merge their own deltas
        assert (sorted(map(tuple, t.snapshot(as_of).select(*C.TXN_OUT).collect()))
                == sorted(map(tuple, V.snapshot(txe, as_of=as_of).select(*C.TXN_OUT).collect())))


def _scanned(df):
    """Rows that the data scans have put out."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    scans = [leaves.apply(i) for i in range(leaves.size())]
    return sum(s.metrics().apply("numOutputRows").value() for s in scans
               if s.nodeName().startswith("Scan parquet") and "/data" in s.toString())


def test_bloom_filters_skip_files_without_the_key(spark, tmp_table):
    """A key within every file's range but in none of them: the files' Bloom filters say so."""
    t = LakeTable(spark, tmp_table("bloom"), table_type="cow", keys=("parcelId",), partition=None, buckets=2)
    df = spark.range(0, 20_000, 2).selectExpr("lpad(CAST(id AS STRING), 6, '0') AS parcelId", "'a' AS area",
                                              "CAST(id AS STRING) AS transactionId", "'2024-01-01T00:00:00' AS transactionDate")
    t.upsert(df, commit="001")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        absent, there = t.lookup("010001"), t.lookup("010002")
        assert absent.count() == 0 and _scanned(absent) == 0
        assert [r.transactionId for r in there.collect()] == ["10002"] and 0 < _scanned(there) < 10_000
        spark._jsc.hadoopConfiguration().set("parquet.filter.bloom.enabled", "false")
        assert _scanned(t.lookup("010001")) > 0
    finally:
        spark._jsc.hadoopConfiguration().unset("parquet.filter.bloom.enabled")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [r.size_kb for r in t.storage().filter("path like '%/data/%'").collect()]
    assert max(sizes) < 1024  # the filters are sized by their keys


def test_lookup_of_keys_with_several_columns(spark, tmp_table):
    t = LakeTable(spark, tmp_table("lookup"), keys=("area", "parcelId", "transactionId"), record_key=("parcelId", "transactionId"),
                  buckets=2)
    rows = [(p, a, x, "2024-01-01T00:00:00") for p in "pq" for a in "AB" for x in "12"]
    t.upsert(spark.createDataFrame(rows, "parcelId string, area string, transactionId string, transactionDate string"))
    got = {(r.parcelId, r.transactionId, r.area) for r in t.lookup(("p", "1"), ("q", "2")).collect()}
    assert got == {(p, x, a) for p, x in (("p", "1"), ("q", "2")) for a in "AB"}
