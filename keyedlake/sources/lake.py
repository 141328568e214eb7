"""Path-backed keyed, partitioned, versioned table (copy-on-write or merge-on-read).

Layout under ``<path>``, all of it plain Parquet::

    data/_write=<commit>.<kind>/_slot=<commit>.<kind>.<bucket>.<part>/   rows of one file group
    manifest/_at=<commit>.<action>/                                      what an action wrote

A *file group* is ``(part, bucket)``.  ``part`` encodes the partition value (null and empty are
distinct and never a null directory); the value itself is a data column with its own type.
``bucket = pmod(xxhash64(record key), buckets)``.  A *slot* is one group as one action wrote it:
kind ``b`` holds the group's complete rows as of the commit, kind ``d`` a merge-on-read delta.

The manifest is a table: one row per action and one per slot.  Reads list the commits that hold
slots that count and join the manifest with the data on the slot, a directory name, so Spark prunes
the scan to those slots at run time and picks the join by its statistics.  An action's
manifest rows are written last, so a half-written commit is invisible.  A replayed
commit overwrites its own directories.  Commit ids are text without dots, ordered as text.
"""

from __future__ import annotations

import datetime as _dt
import functools
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import versioned as V
from ..schema import (COMMIT_SEQNO, COMMIT_TIME, FILE_NAME, PARTITION_FIELD, PARTITION_PATH,
                      PRECOMBINE_FIELD, RECORD_KEY, RECORD_KEY_COL, TIE_BREAK_FIELD)

DATA_ACTIONS = ("commit", "deltacommit")
BASE, DELTA = "b", "d"
PART, BUCKET, SLOT, WRITE = "_part", "_bucket", "_slot", "_write"
INTERNAL = (PART, BUCKET, SLOT, WRITE)
METADATA = (COMMIT_TIME, COMMIT_SEQNO, RECORD_KEY_COL, PARTITION_PATH, FILE_NAME)
GROUP = [PART, BUCKET]
_MANIFEST = (f"commit string, action string, kind string, {SLOT} string, {PART} string, {BUCKET} int, rows bigint, "
             "schema string, props string, info string, source string")

#: Types that a column may be widened from, by the table's type.
WIDENS = {"smallint": ("tinyint",), "int": ("tinyint", "smallint"), "bigint": ("tinyint", "smallint", "int"),
          "double": ("tinyint", "smallint", "int", "float"), "timestamp": ("date",)}


def utc_instant() -> str:
    """Batch commit id: UTC ``yyyyMMddHHmmssSSS``."""
    now = _dt.datetime.now(_dt.timezone.utc)
    return now.strftime("%Y%m%d%H%M%S") + f"{now.microsecond // 1000:03d}"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its store's scheme, as Spark's listings have it."""
    fs, p = _fs(spark, path)
    return fs.makeQualified(p).toString()


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


class LakeTable:
    """A keyed table at ``path``.

    ``keys``: the record key scope (default ``(area, parcelId)``: the key is unique within its
    partition).  ``precombine``/``tie``: in-batch ordering.  ``merge_mode``: ``commit_time`` (incoming
    wins) or ``event_time`` (greatest precombine across commits wins).  ``join_hint``: a join strategy
    for the manifest instead of Spark's choice.
    """

    def __init__(self, spark: SparkSession, path: str, *, table_type: str = "cow",
                 keys: Sequence[str] = (PARTITION_FIELD, RECORD_KEY), partition: str | None = PARTITION_FIELD,
                 record_key: Sequence[str] = (RECORD_KEY,), precombine: Sequence[str] = (PRECOMBINE_FIELD,),
                 tie: Sequence[str] = (TIE_BREAK_FIELD,), merge_mode: str = "commit_time", buckets: int = 16,
                 join_hint: str | None = None, max_records_per_file: int | None = None,
                 compact_every: int | None = None, retain_commits: int | None = None):
        if table_type not in ("cow", "mor"):
            raise ValueError("table_type is 'cow' or 'mor'")
        self.spark, self.path = spark, path.rstrip("/")
        self.table_type, self.keys, self.partition = table_type, list(keys), partition
        self.record_key, self.precombine, self.tie = list(record_key), list(precombine), list(tie)
        self.merge_mode, self.buckets, self.join_hint = merge_mode, buckets, join_hint
        # file-size cap for rewrites (~128 MB / average row size at scale)
        self.max_records_per_file = max_records_per_file
        # merge-on-read: compact after this many delta commits (None = manual only)
        self.compact_every = compact_every
        self.retain_commits = retain_commits

    # ------------------------------------------------------------ manifest
    def manifest(self) -> DataFrame:
        """One row per action (``kind`` null) and one per slot it wrote."""
        root = f"{self.path}/manifest"
        if not path_exists(self.spark, root):
            return self.spark.createDataFrame([], _MANIFEST)
        return self.spark.read.schema(_MANIFEST).parquet(root).drop("_at")

    def actions(self) -> DataFrame:
        return self.manifest().filter("kind is null").drop("kind", *GROUP, SLOT)

    def timeline(self) -> list[Row]:
        """Finished actions in commit order."""
        return self.actions().orderBy("commit", "action").collect()

    def commits(self) -> list[str]:
        """Data commits (upserts), in order; compaction and clean excluded."""
        return [r["commit"] for r in self._data_commits().orderBy("commit").collect()]

    def _data_commits(self) -> DataFrame:
        return self.actions().filter(F.col("action").isin(*DATA_ACTIONS)).select("commit").distinct()

    def _state(self, commit: str | None = None) -> Row:
        """Latest commit, its schema, the commit before ``commit``, the oldest commit kept and the latest
        commit folded or cleaned."""
        data = F.col("action").isin(*DATA_ACTIONS)
        return self.actions().agg(
            F.max(F.when(data, F.col("commit"))).alias("latest"),
            F.max(F.when(data & (F.col("commit") < (commit or "")), F.col("commit"))).alias("before"),
            F.max_by("schema", F.when(data, F.col("commit"))).alias("schema"),
            F.max(F.when(F.col("action") == "clean", F.col("info"))).alias("kept"),
            F.max(F.when(~data, F.col("commit"))).alias("folded")).first()

    def _at(self, as_of: str | None = None) -> tuple[str, T.StructType]:
        """(commit to read, the table's columns)."""
        state = self._state()
        if state["latest"] is None:
            raise ValueError(f"table at {self.path} has no commits")
        as_of = state["latest"] if as_of is None else as_of
        if state["kept"] is not None and as_of < state["kept"]:
            raise ValueError(f"commit {as_of} was cleaned (history kept from {state['kept']})")
        return as_of, T.StructType.fromJson(json.loads(state["schema"]))

    def _slots(self, as_of: str) -> DataFrame:
        """The slots that make up the table as of a commit; ``dirty``: the group has deltas newer than its base."""
        slots = self.manifest().filter((F.col("kind") > "") & (F.col("commit") <= as_of))
        base, delta = F.col("kind") == BASE, F.col("kind") == DELTA
        groups = slots.groupBy(*GROUP).agg(F.max(F.when(base, F.col("commit"))).alias("base"),
                                           F.max(F.when(delta, F.col("commit"))).alias("newest"))
        groups = groups.withColumn("dirty", F.coalesce(F.col("newest") > F.coalesce("base", F.lit("")), F.lit(False)))
        current = (base & (F.col("commit") == F.col("base"))) | (
            delta & (F.col("commit") > F.coalesce("base", F.lit(""))))
        return slots.join(groups, GROUP).filter(current).select(SLOT, *GROUP, "commit", "kind", "dirty")

    # ------------------------------------------------------------ reads
    def _scan(self, schema: T.StructType, slots: DataFrame) -> DataFrame:
        """Rows of the commits that hold ``slots``, with their slot: only those commits' folders are
        listed.  Names of commits pass the driver, those of groups and files don't."""
        found = T.StructType([*schema.fields, T.StructField(WRITE, T.StringType()), T.StructField(SLOT, T.StringType())])
        writes = [r[0] for r in slots.select(F.concat_ws(".", "commit", "kind")).distinct().collect()]
        if not writes:
            return self._valued(self.spark.createDataFrame([], found))
        rows = self.spark.read.schema(found).option("basePath", f"{self.path}/data").parquet(
            *[f"{self.path}/data/{WRITE}={w}" for w in sorted(writes)])
        return self._valued(rows)

    def _valued(self, rows: DataFrame) -> DataFrame:
        """The partition column told by its directory, so filters on it prune directories;
        types that text can't give back exactly are read from the files."""
        if not self.partition or not isinstance(rows.schema[self.partition].dataType,
                                                (T.StringType, T.IntegralType, T.BooleanType, T.DateType)):
            return rows
        part = F.split(SLOT, r"\.", 4)[3]
        value = F.url_decode(F.replace(F.substr(part, F.lit(3)), F.lit("~"), F.lit("%")))
        return rows.withColumn(self.partition, F.when(part != "n", value).cast(rows.schema[self.partition].dataType))

    def _of(self, rows: DataFrame, slots: DataFrame) -> DataFrame:
        slots = slots.select(SLOT)
        return rows.join(slots.hint(self.join_hint) if self.join_hint else slots, SLOT)

    def _read(self, as_of: str, schema: T.StructType, after: str | None = None, file_names: bool = False,
              touched: DataFrame | None = None) -> DataFrame:
        """Rows as of a commit, newer than ``after``; only groups that are ``touched``, if given."""
        slots = self._slots(as_of)
        if touched is not None:
            slots = slots.join(touched, GROUP, "left_semi")
        if after is not None:
            slots = slots.filter(F.col("commit") > after)
        rows = self._scan(schema, slots)
        columns = schema.fieldNames() + ([FILE_NAME] if file_names else [])
        if file_names:
            rows = rows.withColumn(FILE_NAME, F.col("_metadata.file_name"))
        if after is not None:
            rows = rows.filter(F.col(COMMIT_TIME) > after)
        if self.table_type == "cow":  # every group is one slot: nothing to merge, no shuffle of rows
            return self._of(rows, slots).select(*columns)
        clean = self._of(rows, slots.filter(~F.col("dirty"))).select(*columns)
        return clean.unionByName(self._latest(self._of(rows, slots.filter("dirty")).select(*columns)))

    def snapshot(self, as_of: str | None = None, file_names: bool = False) -> DataFrame:
        """Latest version of every key (optionally as of a commit, inclusive).
        ``file_names`` adds ``_file_name``: the data file each row was read from."""
        return self._read(*self._at(as_of), file_names=file_names)

    as_of = snapshot

    def lookup(self, *keys: Sequence | str | int, as_of: str | None = None) -> DataFrame:
        """Current rows of the given record keys (tuples where the key has several columns).  The keys are
        pushed down to the scan as they are, where the files' Bloom filters tell which to open."""
        rows, named = self.snapshot(as_of), [k if isinstance(k, (tuple, list)) else (k,) for k in keys]
        for i, column in enumerate(self.record_key):  # each column prunes by itself
            rows = rows.filter(F.col(column).isin(sorted({k[i] for k in named})))
        if len(self.record_key) == 1:
            return rows
        match = [F.struct(*self.record_key) == F.struct(*[F.lit(v) for v in k]) for k in named]
        return rows.filter(functools.reduce(lambda a, b: a | b, match, F.lit(False)))

    def read_optimized(self) -> DataFrame:
        """Base slots only: fast, and stale until the next compaction."""
        at, schema = self._at()
        slots = self._slots(at).filter(F.col("kind") == BASE)
        return self._of(self._scan(schema, slots), slots).select(*schema.fieldNames())

    def incremental(self, begin: str, end: str | None = None) -> DataFrame:
        """Keys whose version as of ``end`` was written in ``(begin, end]``.  Under commit-time merging a
        slot at or before ``begin`` holds nothing newer, so such slots aren't read."""
        end, schema = self._at(end)
        if self.merge_mode != "commit_time":
            return self._read(end, schema).filter(F.col(COMMIT_TIME) > begin)
        return self._read(end, schema, after=begin)

    def history(self) -> DataFrame:
        """All retained row versions (the changelog still reachable)."""
        _, schema = self._at()
        kept = self._state()["kept"]
        slots = self.manifest().filter(F.col("kind") > "")
        base = F.col("kind") == BASE
        # the oldest base that counts: the latest one before the retained commits, or else each group's first (a
        # compaction only folds deltas that are there still)
        first = (F.max(F.when(base & (F.col("commit") < kept), F.col("commit"))) if kept is not None else
                 F.min(F.when(base & (F.col("action") != "compaction"), F.col("commit"))))
        groups = slots.groupBy(*GROUP).agg(first.alias("first"))
        reach = F.when(base, F.col("commit") == F.col("first") if self.table_type == "mor" else
                       F.col("commit") >= F.col("first")).otherwise(F.col("commit") > F.col("first"))
        reach = F.col("first").isNull() | reach
        slots = slots.join(groups, GROUP).filter(reach)
        return (self._of(self._scan(schema, slots), slots)
                .select(*schema.fieldNames()).dropDuplicates([*self.keys, COMMIT_TIME]))

    # ------------------------------------------------------------ writes
    def _part_col(self) -> Column:
        """The partition value as a directory name: never null or empty, null and '' distinct."""
        if not self.partition:
            return F.lit("v.")
        value = F.url_encode(F.col(self.partition).cast("string"))
        value = F.replace(F.replace(value, F.lit("%"), F.lit("~")), F.lit("*"), F.lit("~2A"))
        return F.coalesce(F.concat(F.lit("v."), value), F.lit("n"))

    def _bucket_col(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k) for k in self.record_key]), F.lit(self.buckets)).cast("int")

    def _with_group(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(PART, self._part_col()).withColumn(BUCKET, self._bucket_col())

    def _tie(self, rows: DataFrame) -> list[str]:
        return [c for c in self.tie if c in rows.columns]

    def _stamp(self, batch: DataFrame, commit: str) -> DataFrame:
        """Precombine the batch and add the commit / key / group columns.  The table's own
        metadata columns are made anew; other columns are kept whatever their names."""
        clash = sorted(set(batch.columns) & set(INTERNAL))
        if clash:
            raise ValueError(f"columns {clash} are names that the table uses itself")
        rows = V.precombine(batch, self.keys, [c for c in self.precombine if c in batch.columns], self._tie(batch))
        rk = self.record_key
        rec = F.col(rk[0]).cast("string") if len(rk) == 1 else F.concat_ws(
            ",", *[F.concat(F.lit(f"{k}:"), F.col(k).cast("string")) for k in rk])
        ppath = (F.concat(F.lit(f"{self.partition}="), F.coalesce(F.col(self.partition).cast("string"), F.lit("")))
                 if self.partition else F.lit(""))
        return self._with_group(rows.select(
            F.lit(commit).alias(COMMIT_TIME),
            F.concat_ws("_", F.lit(commit), F.spark_partition_id().cast("string"),
                        F.monotonically_increasing_id().cast("string")).alias(COMMIT_SEQNO),
            rec.alias(RECORD_KEY_COL), ppath.alias(PARTITION_PATH),
            *[F.col(c) for c in rows.columns if c not in METADATA]))

    @staticmethod
    def _merged_schema(stamped: DataFrame, old: T.StructType | None) -> T.StructType:
        """Schema reconcile: table schema plus any new batch columns."""
        new = T.StructType([f for f in stamped.schema.fields if f.name not in INTERNAL])
        if old is None:
            return new
        fields = list(old.fields)
        for f in new.fields:
            if f.name not in old.fieldNames():
                fields.append(f)
                continue
            was, now = old[f.name].dataType.simpleString(), f.dataType.simpleString()
            if was != now and now not in (*WIDENS.get(was, ()), "void"):
                raise TypeError(f"column {f.name} is {was}; a batch of {now} would lose values")
        return T.StructType(fields)

    @staticmethod
    def _align(df: DataFrame, schema: T.StructType, extra: Sequence[str] = ()) -> DataFrame:
        cols = [F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
                for f in schema.fields]
        return df.select(*cols, *[F.col(c) for c in extra])

    def _write_rows(self, rows: DataFrame, commit: str, kind: str, grouped: bool = False) -> DataFrame:
        """Write rows as slots of one action; returns (slot, group, rows) as read back from file footers.
        Rows not yet clustered by file group are rebalanced (AQE splits a hot group into ~128 MB files)."""
        target = f"{self.path}/data/{WRITE}={commit}.{kind}"
        rows = rows if grouped else rows.hint("rebalance", *GROUP)
        slot = F.concat_ws(".", F.lit(commit), F.lit(kind), BUCKET, PART)
        # a replay replaces the whole action, whatever overwrite mode the session has
        w = rows.withColumn(SLOT, slot).drop(*GROUP).write.mode("overwrite").option("partitionOverwriteMode", "static")
        # Parquet's own Bloom filters on the key: a read of few keys skips row groups that can't hold them
        w = w.options(**{f"parquet.bloom.filter.enabled#{k}": "true" for k in self.record_key},
                      **{"parquet.bloom.filter.adaptive.enabled": "true"})
        if self.max_records_per_file:
            w = w.option("maxRecordsPerFile", str(self.max_records_per_file))
        w.partitionBy(SLOT).parquet(target)
        names = F.split(SLOT, r"\.", 4)
        return (self.spark.read.schema(f"{SLOT} string").parquet(target).groupBy(SLOT)
                .agg(F.count(F.lit(1)).alias("rows"))
                .select(F.lit(kind).alias("kind"), SLOT, names[3].alias(PART), names[2].cast("int").alias(BUCKET), "rows"))

    def _record(self, commit: str, action: str, slots: DataFrame | None = None, rows: int = 0,
                schema: T.StructType | None = None, info: str | None = None, source: str | None = None) -> None:
        """The action's manifest rows, which make it visible: written as one file, renamed into place."""
        props = json.dumps(self.properties())
        out = self.spark.createDataFrame(
            [(commit, action, None, None, None, None, rows, schema.json() if schema else None, props, info, source)],
            _MANIFEST)
        if slots is not None:
            out = out.unionByName(slots.withColumns({"commit": F.lit(commit), "action": F.lit(action)}),
                                  allowMissingColumns=True)
        (out.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static")
         .parquet(f"{self.path}/manifest/_at={commit}.{action}"))

    @staticmethod
    def _next(latest: str | None) -> str:
        """A commit id above all others: the UTC instant, or for a table that counts its
        commits in ids of another width, the next number."""
        latest = latest or ""
        after = str(int(latest) + 1).zfill(len(latest)) if latest.isdigit() else ""
        return after if after and len(latest) != len(utc_instant()) else max(utc_instant(), after)

    def next_commit(self) -> str:
        return self._next(self._state()["latest"])

    def source_commit(self, source: str) -> str | None:
        """The commit that a batch named ``source`` was written as."""
        return self.actions().filter(F.col("source") == source).agg(F.max("commit")).first()[0]

    def upsert(self, batch: DataFrame, commit: str | None = None, source: str | None = None,
               seen: Observation | None = None) -> str | None:
        """Write one batch as commit ``commit`` (default: UTC instant).

        Merge-on-read writes the batch as a delta.  Copy-on-write lands the batch and rewrites the
        file groups it touches: current and landed rows are shuffled once by group.  An
        empty batch writes nothing.  Replaying the latest commit id rewrites that commit; an
        older id, or one that a compaction or a clean has folded, is refused.
        ``source`` names what the batch is, so that a stream can tell a replay; ``seen`` observes
        the number of rows (keys) written.
        """
        commit = commit or self.next_commit()
        state = self._state(commit)
        latest, before = state["latest"], state["before"]
        if "." in commit or "/" in commit:
            raise ValueError(f"commit id {commit!r}: dots and slashes are the table's own")
        if commit < (latest or ""):
            raise ValueError(f"commit {commit} is older than the latest, {latest}: its rows could not be seen")
        if commit == latest and (state["folded"] or "") >= commit:
            raise ValueError(f"commit {commit} has been compacted or cleaned and can't be replayed")
        old = T.StructType.fromJson(json.loads(state["schema"])) if before is not None else None
        stamped = self._stamp(batch, commit)
        schema = self._merged_schema(stamped, old)
        seen = seen or Observation()
        incoming = self._align(stamped, schema, GROUP).observe(seen, F.count(F.lit(1)).alias("rows"))
        kind = BASE if before is None or self.table_type == "cow" else DELTA
        landing = None
        if kind == BASE and before is not None:
            landing = f"{self.path}/landing/{commit}"
            incoming.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(landing)
            landed = self.spark.read.schema(incoming.schema).parquet(landing)
            current = self._read(before, old, touched=landed.select(*GROUP).distinct())
            incoming = self._reduced(self._align(self._with_group(current), schema, GROUP).unionByName(landed))
        slots = self._write_rows(incoming, commit, kind, grouped=landing is not None)
        if landing:
            delete_path(self.spark, landing)
        written = f"{self.path}/data/{WRITE}={commit}.{kind}"
        fs, p = _fs(self.spark, written)
        if not any(st.isDirectory() for st in fs.listStatus(p)):  # no slot: the batch is empty
            delete_path(self.spark, written)
            return None
        self._record(commit, "commit" if self.table_type == "cow" else "deltacommit", slots, seen.get["rows"], schema,
                     source=source)
        if self.table_type == "mor" and self.compact_every:
            self._maybe_compact(self.compact_every)
        if self.retain_commits:
            self._maybe_clean(self.retain_commits)
        return commit

    def _latest(self, rows: DataFrame) -> DataFrame:
        return V.snapshot(rows, self.keys, None, self.merge_mode,
                          [c for c in self.precombine if c in rows.columns], self._tie(rows))

    def _reduced(self, rows: DataFrame) -> DataFrame:
        """Rows (with their group columns) shuffled once by file group, then the latest of
        each key; the window treats null keys as equal."""
        return V.snapshot(rows.repartition(*GROUP), [*GROUP, *self.keys], None, self.merge_mode,
                          [c for c in self.precombine if c in rows.columns], self._tie(rows))

    def _maybe_compact(self, every: int) -> None:
        """Fold deltas once ``every`` delta commits have accumulated since the last base was written."""
        slots = self.manifest()
        base = slots.filter(F.col("kind") == BASE).agg(F.max("commit")).first()[0] or ""
        if slots.filter((F.col("kind") == DELTA) & (F.col("commit") > base)).select("commit").distinct().count() >= every:
            self.compact()

    def _maybe_clean(self, retain: int) -> None:
        """Automatic retention, amortised: clean once ``retain`` new data commits have accumulated
        since the last clean, so at least the latest ``retain`` commits stay queryable and each
        fold covers many commits (a merge-on-read table is not compacted on every write)."""
        last = self.actions().filter("action = 'clean'").agg(F.max("commit")).first()[0]
        since = self._data_commits().filter(F.col("commit") > (last or "")).count()
        if since >= 2 * retain or (last is None and since > retain):
            self.clean(retain)

    def overwrite(self, batch: DataFrame, commit: str | None = None) -> str:
        """Recreate the table from this batch alone.

        The new table is written beside the old one, which the batch may read from, and
        takes its place once it is complete.
        """
        beside = LakeTable(self.spark, f"{self.path}.new-{uuid.uuid4().hex[:8]}", **self.properties(),
                           join_hint=self.join_hint, max_records_per_file=self.max_records_per_file)
        commit = beside.upsert(batch, commit)
        if commit is None:
            raise ValueError("overwrite with an empty batch: the table is left as it is")
        delete_path(self.spark, self.path)
        fs, new = _fs(self.spark, beside.path)
        fs.rename(new, _fs(self.spark, self.path)[1])
        return commit

    # ------------------------------------------------------------ properties
    def properties(self) -> dict:
        return {"table_type": self.table_type, "keys": self.keys, "partition": self.partition,
                "record_key": self.record_key, "precombine": self.precombine, "tie": self.tie,
                "merge_mode": self.merge_mode, "buckets": self.buckets}

    @classmethod
    def exists(cls, spark: SparkSession, path: str) -> bool:
        return path_exists(spark, f"{path.rstrip('/')}/manifest")

    @classmethod
    def open(cls, spark: SparkSession, path: str, **overrides) -> "LakeTable":
        """Open an existing table with the properties it was created with."""
        props = cls(spark, path).actions().agg(F.min_by("props", "commit")).first()[0]
        if props is None:
            raise ValueError(f"table at {path} has no commits")
        return cls(spark, path, **{**json.loads(props), **overrides})

    # ------------------------------------------------------------ services
    def compact(self, at: str | None = None) -> str | None:
        """Fold deltas into new base slots as of ``at`` (default latest).
        Snapshot reads are unchanged; read-optimised reads become fresh."""
        at, schema = self._at(at)
        dirty = self._slots(at).filter("dirty")
        if dirty.isEmpty():
            return None
        rows = self._with_group(self._of(self._scan(schema, dirty), dirty).select(*schema.fieldNames()))
        self._record(at, "compaction", self._write_rows(self._reduced(rows), at, BASE, grouped=True))
        return at

    def clean(self, retain: int, purge: bool = False) -> str | None:
        """Keep the latest ``retain`` commits queryable; older history is
        folded into a base at the commit just before the window."""
        newest = [r["commit"] for r in self._data_commits().orderBy(F.desc("commit")).limit(retain + 1).collect()]
        if len(newest) <= retain:
            return None
        cutoff, before = newest[retain - 1], newest[retain]
        if self.table_type == "mor":
            self.compact(before)
        self._record(newest[0], "clean", info=cutoff)
        if purge:
            self._purge(cutoff)
        return cutoff

    def _purge(self, cutoff: str) -> None:
        """Delete the slots that no retained read can reach."""
        slots = self.manifest().filter(F.col("kind") > "")
        first = (slots.filter((F.col("kind") == BASE) & (F.col("commit") < cutoff)).groupBy(*GROUP)
                 .agg(F.max("commit").alias("first")))
        dead = slots.join(first, GROUP).filter(F.col("commit") < F.col("first"))
        for r in dead.select("commit", "kind", SLOT).toLocalIterator():  # directory names, one at a time
            delete_path(self.spark, f"{self.path}/data/{WRITE}={r['commit']}.{r['kind']}/{SLOT}={r[SLOT]}")

    def storage(self) -> DataFrame:
        from .documents import storage_inventory
        return storage_inventory(self.spark, self.path)
