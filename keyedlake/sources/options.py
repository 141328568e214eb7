"""Option-style entry points for the lake table.

Users coming from an options-driven table format can keep their calls::

    write(df, path, mode="append", **{"table.type": "MERGE_ON_READ",
          "recordkey.field": "parcelId", "partitionpath.field": "area",
          "precombine.field": "transactionDate", "operation": "upsert"})
    read(spark, path)                                        # snapshot
    read(spark, path, **{"as.of.instant": c})                # time travel
    read(spark, path, **{"query.type": "incremental",
                         "begin.instanttime": b, "end.instanttime": e})
    read(spark, path, **{"query.type": "read_optimized"})

Keys may carry any prefix (``<prefix>.datasource.write.table.type`` works
too); only the suffix is matched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .lake import LakeTable

_TABLE_TYPES = {"COPY_ON_WRITE": "cow", "MERGE_ON_READ": "mor", "cow": "cow", "mor": "mor"}


#: The options that are known; any other is refused.
_WRITE_OPTIONS = ("operation", "table.type", "recordkey.field", "partitionpath.field", "precombine.field",
                  "tie.field", "merge.mode", "buckets", "commits.retained", "table.name", "max.records.per.file")
_READ_OPTIONS = ("query.type", "as.of.instant", "begin.instanttime", "end.instanttime")


def _known(options: dict, names) -> None:
    unknown = [k for k in options if not any(k == n or k.endswith("." + n) for n in names)]
    if unknown:
        raise ValueError(f"unknown options {unknown}; known: {', '.join(names)}")


def _opt(options: dict, suffix: str, default=None):
    for k, v in options.items():
        if k == suffix or k.endswith("." + suffix):
            return v
    return default


def _fields(v) -> list[str]:
    return [x.strip() for x in v.split(",")] if isinstance(v, str) else list(v)


def write(df: DataFrame, path: str, mode: str = "append", commit: str | None = None,
          **options) -> str | None:
    """Upsert ``df`` into the table at ``path`` (``mode="overwrite"`` recreates it)."""
    spark = df.sparkSession
    _known(options, _WRITE_OPTIONS)
    op = _opt(options, "operation", "upsert")
    if op != "upsert":
        raise ValueError(f"operation {op!r} is not supported (upsert)")
    exists = LakeTable.exists(spark, path)
    if mode == "overwrite" or not exists:
        record_key = _fields(_opt(options, "recordkey.field", "parcelId"))
        partition = _opt(options, "partitionpath.field", "area") or None
        kw = dict(
            table_type=_TABLE_TYPES[_opt(options, "table.type", "COPY_ON_WRITE")],
            keys=([partition] if partition else []) + record_key,
            partition=partition, record_key=record_key,
            precombine=_fields(_opt(options, "precombine.field", "transactionDate")),
            tie=_fields(_opt(options, "tie.field", "transactionId")),
            merge_mode=_opt(options, "merge.mode", "commit_time"),
            buckets=int(_opt(options, "buckets", 16)),
        )
        table = LakeTable(spark, path, **kw)
    elif mode == "append":
        table = LakeTable.open(spark, path)
    else:
        raise ValueError(f"mode {mode!r} (append, overwrite)")
    retain = _opt(options, "commits.retained")
    if retain is not None:
        table.retain_commits = int(retain)
    most = _opt(options, "max.records.per.file")
    if most is not None:
        table.max_records_per_file = int(most)
    return table.overwrite(df, commit) if mode == "overwrite" else table.upsert(df, commit)


def read(spark: SparkSession, path: str, **options) -> DataFrame:
    """Snapshot (default), time travel, incremental or read-optimised read."""
    _known(options, _READ_OPTIONS)
    table = LakeTable.open(spark, path)
    qtype = _opt(options, "query.type", "snapshot")
    if qtype == "snapshot":
        return table.snapshot(_opt(options, "as.of.instant"))
    if qtype == "incremental":
        begin = _opt(options, "begin.instanttime")
        if begin is None:
            raise ValueError("incremental reads need begin.instanttime")
        return table.incremental(begin, _opt(options, "end.instanttime"))
    if qtype == "read_optimized":
        return table.read_optimized()
    raise ValueError(f"query.type {qtype!r} (snapshot, incremental, read_optimized)")
