"""Versioned keyed table semantics as pure DataFrame functions.

A *changelog* is a frame of stored row versions, each carrying the commit
it was written by (``_commit_time``, a zero-padded string ordered
lexicographically).  Every read mode of the lake table is a reduction of
the changelog to one row per key:

* snapshot        latest version per key (``row_number()==1``; Spark plans a
                  partial ``WindowGroupLimit`` before the shuffle, so a key
                  holding a third of all rows is reduced map-side first)
* as-of / time travel    the same over commits ``<= c`` (inclusive)
* incremental     keys whose latest version ``<= e`` was written in ``(b, e]``
* read-optimised  the base as of the last compaction (see ``sources.lake``)

The path-backed table in :mod:`keyedlake.sources.lake` stores the
changelog on disk and calls these functions; tests and catalogue queries
can use them directly on frames.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import (COMMIT_TIME, PARTITION_FIELD, PRECOMBINE_FIELD, RECORD_KEY,
                      TIE_BREAK_FIELD)

DEFAULT_KEYS = (PARTITION_FIELD, RECORD_KEY)
MERGE_MODES = ("commit_time", "event_time")


def _desc(cols: Sequence[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in cols]


def latest_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of each group under ``order`` (top-1 per group)."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def precombine(df: DataFrame, keys: Sequence[str] = DEFAULT_KEYS,
               order: Sequence[str] = (PRECOMBINE_FIELD,),
               tie: Sequence[str] = (TIE_BREAK_FIELD,),
               within: Sequence[str] = ()) -> DataFrame:
    """In-batch dedup: per key (and per ``within`` columns, e.g. the commit),
    the row with the greatest ordering field wins; ties by ``tie`` desc;
    nulls lose."""
    return latest_per_group(df, [*keys, *within], _desc([*order, *tie]))


def _reduce(log: DataFrame, keys, merge_mode, order, tie) -> DataFrame:
    if merge_mode == "commit_time":
        ordering = _desc([COMMIT_TIME, *order, *tie])
    elif merge_mode == "event_time":
        ordering = _desc([*order, COMMIT_TIME, *tie])
    else:
        raise ValueError(f"merge_mode must be one of {MERGE_MODES}")
    return latest_per_group(log, keys, ordering)


def snapshot(log: DataFrame, keys: Sequence[str] = DEFAULT_KEYS, as_of: str | None = None,
             merge_mode: str = "commit_time", order: Sequence[str] = (PRECOMBINE_FIELD,),
             tie: Sequence[str] = (TIE_BREAK_FIELD,)) -> DataFrame:
    """Latest version of every key, optionally as of commit ``as_of`` (inclusive).

    The commit filter sits *below* the per-key reduction, so on a
    commit-partitioned layout it becomes a partition filter.
    """
    rows = log if as_of is None else log.filter(F.col(COMMIT_TIME) <= F.lit(as_of))
    return _reduce(rows, keys, merge_mode, order, tie)


def incremental(log: DataFrame, begin: str, end: str | None = None,
                keys: Sequence[str] = DEFAULT_KEYS, merge_mode: str = "commit_time",
                order: Sequence[str] = (PRECOMBINE_FIELD,),
                tie: Sequence[str] = (TIE_BREAK_FIELD,)) -> DataFrame:
    """Rows changed in ``(begin, end]`` (open end = up to the latest commit).

    Under ``commit_time`` merging the range is pruned before the reduction
    (only commits in the range are read).  Under ``event_time`` merging an
    older commit can still win, so the as-of reduction runs first.
    """
    c = F.col(COMMIT_TIME)
    if merge_mode == "commit_time":
        rng = c > F.lit(begin)
        if end is not None:
            rng = rng & (c <= F.lit(end))
        return _reduce(log.filter(rng), keys, merge_mode, order, tie)
    snap = snapshot(log, keys, end, merge_mode, order, tie)
    return snap.filter(c > F.lit(begin))


def history_after_retention(log: DataFrame, cutoff: str, keys: Sequence[str] = DEFAULT_KEYS,
                            merge_mode: str = "commit_time",
                            order: Sequence[str] = (PRECOMBINE_FIELD,),
                            tie: Sequence[str] = (TIE_BREAK_FIELD,)) -> DataFrame:
    """Changelog after keeping commits ``>= cutoff``: the retained versions
    plus the state just before the window, folded to one row per key.
    Every as-of read at or after ``cutoff`` is unchanged."""
    c = F.col(COMMIT_TIME)
    recent = log.filter(c >= F.lit(cutoff))
    folded = snapshot(log.filter(c < F.lit(cutoff)), keys, None, merge_mode, order, tie)
    return recent.unionByName(folded)

