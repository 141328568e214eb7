"""Scalar rules for the relational path: defaults, event time, conformance."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import AMOUNT_PRECISION, AMOUNT_SCALE, RELATIONAL_COLUMNS, VARCHAR_LIMITS

# --- fixed values: accepted event-time text (ISO date, 'T' or space, h:m:s, optional fraction)
EVENT_TIME_PATTERN = r"^\s*\d{4}-\d{1,2}-\d{1,2}[T ]\d{1,2}:\d{1,2}:\d{1,2}([.]\d{1,9})?\s*$"


def norm_event_time(c: Column | str) -> Column:
    """Text -> timestamp_ntz; blank, date-only, zoned or junk text -> null.

    Never raises (ANSI-safe): the pattern guard rejects shapes a plain cast
    would accept too generously, ``try_cast`` rejects impossible dates.
    """
    s = F.col(c) if isinstance(c, str) else c
    text = F.regexp_replace(F.trim(s), "T", " ")
    return F.when(s.rlike(EVENT_TIME_PATTERN), text.try_cast("timestamp_ntz"))


def _field(df: DataFrame, name: str, dtype: str) -> Column:
    """Column if present, else a typed null (missing field is not an error)."""
    if name in df.columns:
        return F.col(name)
    return F.lit(None).cast(dtype)


def to_relational(df: DataFrame, amount_default: float = 0.0) -> DataFrame:
    """Camel-case transaction rows -> the relational table's snake-case columns.

    Null / missing amount, partition and offset become 0 (this path only);
    the amount is brought to NUMERIC(15,2) (null when it does not fit, which
    :func:`conform_to_table` reports); event time is parsed by
    :func:`norm_event_time`.
    """
    dec = f"decimal({AMOUNT_PRECISION},{AMOUNT_SCALE})"
    cols = []
    for target, source, kind, _ in RELATIONAL_COLUMNS:
        if kind == "varchar":
            cols.append(_field(df, source, "string").cast("string").alias(target))
        elif kind.startswith("numeric"):
            v = F.coalesce(_field(df, source, "double"), F.lit(amount_default))
            cols.append(v.try_cast(dec).alias(target))
        elif kind == "timestamp":
            cols.append(norm_event_time(_field(df, source, "string")).alias(target))
        elif kind == "int":
            cols.append(F.coalesce(_field(df, source, "int"), F.lit(0)).cast("int").alias(target))
        elif kind == "bigint":
            cols.append(F.coalesce(_field(df, source, "bigint"), F.lit(0)).cast("bigint").alias(target))
    extra = [c for c in df.columns if c.startswith("_")]
    return df.select(*cols, *[F.col(c) for c in extra])


def conform_to_table(df: DataFrame, limits: Mapping[str, int] | None = None,
                     amount_column: str = "transaction_amount",
                     amount_source: str | None = None) -> DataFrame:
    """Add ``_reject_reason`` (null when the row fits the table).

    Checks: key present, varchar lengths, amount within NUMERIC(15,2)
    (``to_relational`` leaves null there only on overflow).
    """
    lim = dict(VARCHAR_LIMITS)
    lim.update(limits or {})
    checks = [F.when(F.col("parcel_id").isNull(), F.lit("parcel_id is null"))]
    for c, n in lim.items():
        if c in df.columns:
            checks.append(
                F.when(F.length(c) > n, F.lit(f"{c} longer than {n}"))
            )
    if amount_column in df.columns:
        checks.append(F.when(F.col(amount_column).isNull(),
                             F.lit(f"{amount_column} out of range")))
    reason = F.concat_ws("; ", *checks)
    return df.withColumn("_reject_reason", F.when(reason != "", reason))


def split_valid_rejected(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two frames over one plan: rows to write, and rows with their reason."""
    valid = df.filter(F.col("_reject_reason").isNull()).drop("_reject_reason")
    rejected = df.filter(F.col("_reject_reason").isNotNull())
    return valid, rejected


#: Folders of the document kinds under the store's root.
DOCUMENT_FOLDERS = {"title": "pdfs/titles", "image": "images"}


def document_uri(root: str, parcel: Column | str, file_name: Column | str, kind: str = "title") -> Column:
    """``<root>/<folder of the kind>/<parcel>/<file>`` as a column expression."""
    p = F.col(parcel) if isinstance(parcel, str) else parcel
    f = F.col(file_name) if isinstance(file_name, str) else file_name
    return F.concat_ws("/", F.lit(root.rstrip("/")), F.lit(DOCUMENT_FOLDERS[kind]), p, f)


def file_class(name: Column | str) -> Column:
    """PARQUET / LOG / OTHER by file name, as a storage listing shows it."""
    n = F.col(name) if isinstance(name, str) else name
    return (F.when(n.endswith(".parquet"), F.lit("PARQUET"))
            .when(n.contains(".log"), F.lit("LOG"))
            .otherwise(F.lit("OTHER")))


def size_kb(length: Column | str) -> Column:
    l = F.col(length) if isinstance(length, str) else length
    return F.floor(l / 1024).cast("bigint")
