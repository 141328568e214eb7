"""Exact dedup: 128-bit content hash groups, bytes compared inside each group.

The content of a text is what is left after deleting space and the control
characters 0x09 to 0x0D.  Rows are grouped by the MD5 of the content *and* by
the content itself, so two contents with one hash never meet in one group.
The grouping is an ordinary aggregate: copies are folded inside each map task
before the shuffle, which bounds what a hot text costs to one row a task.

Defined results
---------------
* null text counts as the empty text; all empty texts are copies of each other;
* of a group the row with the most code points in its original text stays, then
  the smallest ``doc_id``; a null ``doc_id`` comes last;
* rows that repeat a ``doc_id`` and its text count in ``group_size`` and share
  their verdict; ``drop_copies`` leaves one of them; of an id with several texts it
  judges each;
* an empty table gives an empty result; further columns are ignored by
  ``exact_groups`` and kept by ``drop_copies``, whatever their names.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The characters that equality ignores.
IGNORED = " \t\n\x0b\x0c\r"

_TOP, _STEP = Decimal(2**63), Decimal(2**65)


def content(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), IGNORED, "")


def _priority(n_chars: Column, doc_id: Column) -> Column:
    """(more code points, smaller id) as one decimal, so that ``max`` folds in place.

    The lower 65 bits hold ``2**63 - doc_id`` (1 or more), or 0 for a null id.
    """
    rank = F.coalesce(F.lit(_TOP) - doc_id.cast("decimal(20,0)"), F.lit(Decimal(0)))
    return (n_chars.cast("decimal(12,0)") * F.lit(_STEP) + rank).cast("decimal(38,0)")


def _id_of(priority: Column) -> Column:
    rank = priority % F.lit(_STEP)
    return F.when(rank > 0, (F.lit(_TOP) - rank).cast("long"))


def _verdicts(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, h128, digest, keep_id, group_size."""
    rows = docs.select("doc_id", F.length(F.coalesce("text", F.lit(""))).alias("n_chars"),
                       content(F.col("text")).alias("content"))
    groups = (rows.groupBy(F.unhex(F.md5("content")).alias("h128"), "content")
              .agg(F.max(_priority(F.col("n_chars"), F.col("doc_id"))).alias("best"),
                   F.count(F.lit(1)).alias("group_size"))
              .select("h128", F.unhex(F.sha2("content", 256)).alias("digest"),
                      _id_of(F.col("best")).alias("keep_id"), "group_size"))
    members = rows.select("doc_id", F.unhex(F.md5("content")).alias("h128"),
                          F.unhex(F.sha2("content", 256)).alias("digest"))
    return members.join(groups, ["h128", "digest"])


def exact_groups(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    return _verdicts(docs).select("doc_id", "keep_id", "group_size",
                                  F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                                  F.lower(F.hex("digest")).alias("text_sha256"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without its exact copies; all columns stay.

    The verdict is the row's, not the id's: of an id with several texts, those that are copies of
    another document go.  The semi join moves each text once, by ``doc_id`` and the content's
    hash; rows that repeat an id and a content are folded in the same partitioning, the one with the
    most code points stays.
    """
    h128 = F.unhex(F.md5(content(docs["text"])))
    keep = (_verdicts(docs).filter(F.col("doc_id").eqNullSafe(F.col("keep_id")))
            .select(F.col("doc_id").alias("__keep_id"), F.col("h128").alias("__keep_h128")).distinct())
    rows = docs.withColumn("__h128", h128)
    rows = rows.join(keep, rows["doc_id"].eqNullSafe(keep["__keep_id"]) & (rows["__h128"] == keep["__keep_h128"]),
                     "left_semi")
    first = Window.partitionBy("doc_id", "__h128").orderBy(F.length(F.coalesce("text", F.lit(""))).desc(), "text")
    return rows.withColumn("__nth", F.row_number().over(first)).filter("__nth = 1").drop("__nth", "__h128")
