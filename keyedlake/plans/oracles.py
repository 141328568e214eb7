"""DuckDB oracle SQL for the catalogue (same fixtures, written independently
as plain SQL over the driver's pre-registered views)."""

from __future__ import annotations

#: The timestamp texts that are read (all others are null), and the store's root.
EVENT_TIME_PATTERN = r"^\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}[ T][0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}(\.[0-9]{1,9})?\s*$"
DOCUMENT_ROOT = "hdfs://store/files"

TXN = ("transactionId, parcelId, transactionType, propertyType, area, city, buyerName, sellerName, "
       "transactionAmount, currency, titleDeedUri, status, validationStatus, transactionDate")
TXN_OUT = TXN + ", kafka_partition, kafka_offset, _commit_time"

_S = "CAST(NULL AS VARCHAR)"

TXE = f"""txe AS (
  SELECT CAST(event_id AS VARCHAR) AS transactionId, CAST(user_id AS VARCHAR) AS parcelId,
         {_S} AS transactionType, {_S} AS propertyType, event_type AS area, {_S} AS city,
         {_S} AS buyerName, {_S} AS sellerName, value AS transactionAmount, 'PHP' AS currency,
         {_S} AS titleDeedUri, {_S} AS status, {_S} AS validationStatus,
         strftime(ts, '%Y-%m-%dT%H:%M:%S') AS transactionDate,
         CAST(0 AS INTEGER) AS kafka_partition, event_id AS kafka_offset,
         lpad(CAST(event_id % 5 AS VARCHAR), 3, '0') AS _commit_time
  FROM events)"""

TXO = f"""txo AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS transactionId, CAST(o.o_custkey AS VARCHAR) AS parcelId,
         o.o_orderpriority AS transactionType, {_S} AS propertyType, n.n_name AS area, {_S} AS city,
         {_S} AS buyerName, {_S} AS sellerName, o.o_totalprice AS transactionAmount, 'PHP' AS currency,
         {_S} AS titleDeedUri, o.o_orderstatus AS status, {_S} AS validationStatus,
         strftime(o.o_orderdate, '%Y-%m-%dT%H:%M:%S') AS transactionDate,
         CAST(0 AS INTEGER) AS kafka_partition, o.o_orderkey AS kafka_offset,
         CAST(year(o.o_orderdate) AS VARCHAR) AS _commit_time
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
       JOIN nation n ON c.c_nationkey = n.n_nationkey)"""


def pre(src: str = "txe", name: str = "pre") -> str:
    return (f"{name} AS (SELECT * FROM {src} QUALIFY row_number() OVER (PARTITION BY area, parcelId, "
            f"_commit_time ORDER BY transactionDate DESC NULLS LAST, transactionId DESC NULLS LAST) = 1)")


def snap(where: str = "TRUE", src: str = "pre") -> str:
    return (f"SELECT * FROM {src} WHERE {where} QUALIFY row_number() OVER "
            f"(PARTITION BY area, parcelId ORDER BY _commit_time DESC) = 1")


def parse_time(c: str) -> str:
    return (f"CASE WHEN regexp_matches({c}, '{EVENT_TIME_PATTERN}') "
            f"THEN TRY_CAST(replace(trim({c}), 'T', ' ') AS TIMESTAMP) END")


REL = (f"parcelId AS parcel_id, transactionId AS transaction_id, transactionType AS transaction_type, "
       f"propertyType AS property_type, area, city, buyerName AS buyer_name, sellerName AS seller_name, "
       f"TRY_CAST(coalesce(transactionAmount, 0) AS DECIMAL(15,2)) AS transaction_amount, currency, "
       f"titleDeedUri AS title_deed_uri, status, validationStatus AS validation_status, "
       f"{parse_time('transactionDate')} AS transaction_date, "
       f"CAST(coalesce(kafka_partition, 0) AS INTEGER) AS kafka_partition, "
       f"CAST(coalesce(kafka_offset, 0) AS BIGINT) AS kafka_offset")

W = "INTERVAL '5 minutes'"
WINDOWS = (f"windows AS (SELECT time_bucket({W}, ts) AS window_start, time_bucket({W}, ts) + {W} AS window_end, "
           f"event_type AS area, count(*) AS \"count\" FROM events GROUP BY ALL)")

# TXE with a parcelId only where the envelope carries one (every 10th has none)
TXE_KEYED = "txk AS (SELECT * FROM txe WHERE kafka_offset % 10 <> 0)"

RAW_TIME = """CASE event_id % 8
   WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
   WHEN 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
   WHEN 2 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f')
   WHEN 3 THEN strftime(ts, '%Y-%-m-%-dT%H:%M:%S')
   WHEN 4 THEN strftime(ts, '%Y-%m-%d')
   WHEN 5 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+08:00'
   WHEN 6 THEN '   '
   ELSE 'pending#' || CAST(event_id AS VARCHAR) END"""

TXN_NULL_AREA = f"""txe AS (
  SELECT * REPLACE (CASE WHEN kafka_offset % 7 = 0 THEN NULL WHEN kafka_offset % 11 = 0 THEN '' ELSE area END AS area)
  FROM {TXE.replace("txe AS ", "", 1)} t)"""
TXO_NULL_AMOUNT = f"""txo AS (
  SELECT * REPLACE (CASE WHEN kafka_offset % 7 <> 0 THEN transactionAmount END AS transactionAmount)
  FROM {TXO.replace("txo AS ", "", 1)} t)"""
TXO_SNAP = f"WITH {TXO}, {pre('txo')}, s AS ({snap()})"
DOC_ROWS = (f"d AS (SELECT doc_id, source AS parcel_id, 'doc-' || CAST(doc_id AS VARCHAR) || '.txt' AS file_name "
            f"FROM documents)")


def _amount_avg(total: str, n: str) -> str:
    """Half-up average in whole cents (HUGEINT), null where nothing is to be averaged."""
    c = f"CAST({total} * 100 AS HUGEINT)"
    return (f"CASE WHEN {n} > 0 THEN CAST((CASE WHEN {c} < 0 THEN -1 ELSE 1 END) * "
            f"((2 * abs({c}) + {n}) // (2 * {n})) AS DOUBLE) / 100.0 END")


SNAP_LE_001 = snap("_commit_time <= '001'")
SNAP_LE_002 = snap("_commit_time <= '002'")
SNAP_LE_003 = snap("_commit_time <= '003'")

ORACLES: dict[str, str] = {
    "parse_transactions": f"WITH {TXE} SELECT {TXN}, kafka_partition, kafka_offset FROM txe "
                          f"WHERE kafka_offset % 10 <> 0",
    "parse_all_messages": f"""WITH {TXE}
        SELECT CAST(e.user_id AS VARCHAR) AS kafka_key, CAST(0 AS INTEGER) AS kafka_partition,
               e.event_id AS kafka_offset, e.ts AS kafka_timestamp,
               transactionId, CASE WHEN e.event_id % 10 = 0 THEN NULL ELSE parcelId END AS parcelId,
               transactionType, propertyType, area, city, buyerName, sellerName, transactionAmount,
               currency, titleDeedUri, status, validationStatus, transactionDate
        FROM txe JOIN events e ON e.event_id = txe.kafka_offset""",
    "kafka_envelope": "SELECT CAST(user_id AS VARCHAR) AS kafka_key, CAST(0 AS INTEGER) AS kafka_partition, "
                      "event_id AS kafka_offset, ts AS kafka_timestamp FROM events",
    "json_props": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
    "high_value_filter": f"WITH {TXE} SELECT {TXN_OUT} FROM txe WHERE transactionAmount > 100",
    "event_time_parse": f"""WITH r AS (SELECT event_id, {RAW_TIME} AS raw FROM events)
        SELECT event_id, raw, {parse_time('raw')} AS parsed FROM r""",
    "normalize_for_table": f"WITH {TXE} SELECT {REL} FROM txe",
    "reject_invalid_rows": f"""WITH {TXE}
        SELECT parcelId AS parcel_id, transactionId AS transaction_id, area,
               'area longer than 5' AS reason FROM txe WHERE length(area) > 5""",
    "batch_report": f"""WITH {TXE}
        SELECT kafka_offset % 5 AS batch_id, count(*) AS rows_in,
               count(*) FILTER (WHERE length(area) <= 5) AS rows_written,
               count(*) FILTER (WHERE length(area) > 5) AS rows_rejected,
               count(DISTINCT parcelId) FILTER (WHERE length(area) <= 5) AS keys_upserted
        FROM txe GROUP BY ALL""",
    "precombine_dedup": f"WITH {TXE}, {pre()} SELECT {TXN_OUT} FROM pre",
    "snapshot_read": f"WITH {TXE}, {pre()}, s AS ({snap()}) SELECT {TXN_OUT} FROM s",
    "cow_upsert": f"WITH {TXE}, {pre()}, s AS ({snap()}) SELECT {TXN_OUT} FROM s",
    "mor_upsert": f"WITH {TXE}, {pre()}, s AS ({snap()}) SELECT {TXN_OUT} FROM s",
    "snapshot_event_time": f"""WITH {TXE}, {pre()}
        SELECT {TXN_OUT} FROM pre QUALIFY row_number() OVER (PARTITION BY area, parcelId
            ORDER BY transactionDate DESC NULLS LAST, _commit_time DESC, transactionId DESC NULLS LAST) = 1""",
    "time_travel_read": f"WITH {TXE}, {pre()}, s AS ({SNAP_LE_002}) SELECT {TXN_OUT} FROM s",
    "incremental_read": f"WITH {TXE}, {pre()}, s AS ({SNAP_LE_003}) "
                        f"SELECT {TXN_OUT} FROM s WHERE _commit_time > '001'",
    "incremental_read_open": f"WITH {TXE}, {pre()}, s AS ({snap()}) SELECT {TXN_OUT} FROM s "
                             f"WHERE _commit_time > '001'",
    "read_optimized": f"WITH {TXE}, {pre()}, s AS ({SNAP_LE_001}) SELECT {TXN_OUT} FROM s",
    "compact_then_read_optimized": f"WITH {TXE}, {pre()}, s AS ({snap()}) SELECT {TXN_OUT} FROM s",
    "retain_history": f"""WITH {TXE}, {pre()}, s AS ({snap("_commit_time < '003'")})
        SELECT {TXN_OUT} FROM pre WHERE _commit_time >= '003'
        UNION ALL SELECT {TXN_OUT} FROM s""",
    "schema_reconcile": f"""WITH {TXE}, {pre()}, s AS ({snap()})
        SELECT transactionId, parcelId, transactionType, propertyType, area, city, buyerName, sellerName,
               CASE WHEN _commit_time >= '003' THEN NULL ELSE transactionAmount END AS transactionAmount,
               currency, titleDeedUri, status, validationStatus, transactionDate, kafka_partition,
               kafka_offset, _commit_time,
               CASE WHEN _commit_time >= '003' THEN e.props END AS props
        FROM s JOIN events e ON e.event_id = s.kafka_offset""",
    "partitioned_write": f"WITH {TXO} SELECT {TXN} FROM txo",
    "overwrite_roundtrip": f"WITH {TXO} SELECT {TXN}, '002' AS _commit_time FROM txo",
    "table_metadata_columns": f"""WITH {TXE}, {pre()}, s AS ({snap()})
        SELECT _commit_time, parcelId AS _record_key, 'area=' || area AS _partition_path, parcelId, area FROM s""",
    "latest_records_report": f"""{TXO_SNAP}
        SELECT parcelId, transactionId, transactionType, area, transactionAmount, currency, status,
               transactionDate, _commit_time FROM s ORDER BY area, parcelId LIMIT 50""",
    "snapshot_count": f"{TXO_SNAP} SELECT count(*) AS record_count FROM s",
    "area_breakdown": f"""WITH {TXO_NULL_AMOUNT}, {pre('txo')}, s AS ({snap()}), a AS (
            SELECT area, count(*) AS record_count,
                   sum(CAST(transactionAmount AS DECIMAL(18,2))) AS total,
                   count(transactionAmount) AS amounts, max(transactionAmount) AS max_amount FROM s GROUP BY area)
        SELECT area, record_count, {_amount_avg('total', 'amounts')} AS avg_amount, max_amount FROM a""",
    "type_breakdown": f"""{TXO_SNAP}
        SELECT transactionType, count(*) AS "count",
               CAST(sum(CAST(transactionAmount AS DECIMAL(18,2))) AS DOUBLE) AS total_value
        FROM s GROUP BY transactionType""",
    "commit_timeline": f"{TXO_SNAP} SELECT _commit_time, count(*) AS records_in_commit FROM s GROUP BY _commit_time",
    "commit_history": f"{TXO_SNAP} SELECT DISTINCT _commit_time FROM s",
    "nth_commit": f"""{TXO_SNAP}, h AS (SELECT DISTINCT _commit_time FROM s),
        r AS (SELECT _commit_time, row_number() OVER (ORDER BY _commit_time) - 1 AS position FROM h)
        SELECT position, _commit_time FROM r WHERE position IN (0, 1, 2)""",
    "ingest_snapshot_report": f"""WITH {TXE}, {TXE_KEYED}, {pre('txk')}, s AS ({snap()}), a AS (
            SELECT area, count(*) AS record_count,
                   sum(CAST(transactionAmount AS DECIMAL(18,2))) AS total,
                   count(transactionAmount) AS amounts, max(transactionAmount) AS max_amount FROM s GROUP BY area)
        SELECT area, record_count, {_amount_avg('total', 'amounts')} AS avg_amount, max_amount FROM a""",
    "relational_upsert": f"""WITH {TXE}, l AS (SELECT * FROM txe QUALIFY row_number() OVER (
            PARTITION BY parcelId ORDER BY _commit_time DESC, kafka_offset DESC) = 1)
        SELECT {REL} FROM l""",
    "stream_relational_upsert": f"""WITH {TXE}, {TXE_KEYED}, l AS (SELECT * FROM txk QUALIFY row_number() OVER (
            PARTITION BY parcelId ORDER BY _commit_time DESC, kafka_offset DESC) = 1)
        SELECT {REL} FROM l""",
    "stream_upsert_table": f"WITH {TXE}, {TXE_KEYED}, {pre('txk')}, s AS ({snap()}) SELECT {TXN_OUT} FROM s",
    "stream_resume": f"WITH {TXE}, {TXE_KEYED}, {pre('txk')}, s AS ({snap()}) SELECT {TXN_OUT} FROM s",
    "stream_file_passthrough": f"WITH {TXE} SELECT {TXN_OUT} FROM txe",
    "windowed_area_count": f"WITH {WINDOWS} SELECT * FROM windows",
    "stream_window_update": f"WITH {WINDOWS} SELECT * FROM windows",
    "stream_window_append": f"""WITH {WINDOWS}, m AS (SELECT max(ts) AS mx FROM events)
        SELECT w.* FROM windows w, m WHERE w.window_end <= m.mx - INTERVAL '10 minutes'""",
    "stream_stream_join": """SELECT s.user_id, s.event_id AS signup_id, p.event_id AS purchase_id,
               s.ts AS signup_ts, p.ts AS purchase_ts
        FROM events s JOIN events p ON s.user_id = p.user_id
             AND p.ts >= s.ts AND p.ts <= s.ts + INTERVAL '1 hour'
        WHERE s.event_type = 'signup' AND p.event_type = 'purchase'""",
    "kafka_encode": f"WITH {TXE} SELECT {TXN} FROM txe",
    "document_uri": f"""WITH {DOC_ROWS}
        SELECT doc_id, parcel_id, file_name,
               concat_ws('/', '{DOCUMENT_ROOT}', 'pdfs', 'titles', parcel_id, file_name) AS uri FROM d""",
    # one staged text file per document: its bytes are the text plus a newline
    "document_inventory": """SELECT source AS parcel_id, 'doc-' || CAST(doc_id AS VARCHAR) || '.txt' AS file_name,
               CAST(strlen(text) + 1 AS BIGINT) AS length FROM documents""",
    "document_ingest": f"""SELECT source AS parcel_id, 'doc-' || CAST(doc_id AS VARCHAR) || '.txt' AS file_name,
               CAST(strlen(text) + 1 AS BIGINT) AS length, sha256(text || chr(10)) AS sha2,
               concat_ws('/', '{DOCUMENT_ROOT}', 'pdfs', 'titles', source,
                         'doc-' || CAST(doc_id AS VARCHAR) || '.txt') AS uri
        FROM documents""",
    "storage_inventory": """SELECT 'doc-' || CAST(doc_id AS VARCHAR) || '.txt' AS file_name, 'OTHER' AS file_class,
               CAST((strlen(text) + 1) // 1024 AS BIGINT) AS size_kb FROM documents""",
    "document_new_only": f"""WITH {DOC_ROWS}
        SELECT d.doc_id, d.parcel_id, d.file_name FROM d
        WHERE NOT EXISTS (SELECT 1 FROM documents s WHERE s.lang = 'en'
                          AND s.source = d.parcel_id AND 'doc-' || CAST(s.doc_id AS VARCHAR) || '.txt' = d.file_name)""",
}

ORACLES["key_lookup"] = ORACLES["snapshot_read"] + " WHERE parcelId IN ('7', '11', '13')"
ORACLES["packed_append"] = ORACLES["stream_file_passthrough"]
ORACLES["relational_fold"] = ORACLES["relational_upsert"]
BAD = ("CASE WHEN event_id % 19 = 0 AND event_id % 13 <> 0 AND event_id % 17 <> 0 THEN 'no value' "
       "WHEN event_id % 13 = 0 OR event_id % 17 = 0 THEN 'not parsable' WHEN event_id % 10 = 0 THEN 'no parcelId' END")
ORACLES["quarantine_messages"] = f"""WITH r AS (SELECT event_id, {BAD} AS reason FROM events)
    SELECT event_id AS kafka_offset, CASE WHEN reason IS NULL THEN 'kept' ELSE 'quarantined' END AS state, reason FROM r"""
DOC_BYTES = ("b AS (SELECT row_number() OVER () AS rid, source AS parcel_id, "
             "'doc-' || CAST(doc_id AS VARCHAR) || '.txt' AS file_name, "
             "encode(coalesce(text, '') || chr(10)) AS content FROM documents)")
ORACLES["document_chunk_ingest"] = f"""WITH {DOC_BYTES}, k AS (
        SELECT *, unnest(range(0, (octet_length(content) + 999) // 1000)) AS i FROM b),
    h AS (SELECT rid, count(*) AS n_chunks, string_agg(sha256(content[i * 1000 + 1:(i + 1) * 1000]), '' ORDER BY i) AS parts
          FROM k GROUP BY rid)
    SELECT parcel_id, file_name, CAST(octet_length(content) AS BIGINT) AS length, CAST(n_chunks AS INTEGER) AS n_chunks,
           TRUE AS complete, CASE WHEN n_chunks = 1 THEN parts ELSE sha256(parts) END AS digest,
           concat_ws('/', '{DOCUMENT_ROOT}', 'pdfs', 'titles', parcel_id, file_name) AS uri
    FROM b JOIN h USING (rid)"""
ORACLES["document_restore"] = f"""WITH {DOC_BYTES}
    SELECT parcel_id, file_name, CAST(octet_length(content) AS BIGINT) AS length, sha256(content) AS sha2 FROM b"""
ORACLES["document_manifest"] = ORACLES["document_inventory"]
ORACLES["document_reconcile"] = f"""WITH {DOC_ROWS}
    SELECT parcel_id, file_name, 'not in manifest' AS state FROM d JOIN documents USING (doc_id) WHERE lang IS DISTINCT FROM 'en'"""

_BOTH = ("(SELECT 'cow' AS table_type UNION ALL SELECT 'mor')")
for _name in ("cow_upsert_null_area", "mor_upsert_null_area", "wide_table_upsert"):
    ORACLES[_name] = f"WITH {TXN_NULL_AREA}, {pre()}, s AS ({snap()}) SELECT {TXN_OUT} FROM s"
ORACLES["backfill_then_stream"] = ORACLES["cow_upsert"]
ORACLES["history_after_compaction"] = ORACLES["precombine_dedup"]
for _name, _rows in {
        "table_snapshot": f"SELECT * FROM ({snap()})",
        "table_time_travel": f"SELECT * FROM ({SNAP_LE_002})",
        "table_incremental": f"SELECT * FROM ({SNAP_LE_003}) WHERE _commit_time > '001'",
        "table_incremental_open": f"SELECT * FROM ({snap()}) WHERE _commit_time > '001'"}.items():
    ORACLES[_name] = f"WITH {TXE}, {pre()} SELECT table_type, {TXN_OUT} FROM ({_rows}), {_BOTH} k"
ORACLES["stream_batch_report"] = f"""WITH {TXE}, {TXE_KEYED}
    SELECT kafka_offset % 5 AS batch_id, count(*) AS rows_in,
           count(*) FILTER (WHERE length(area) <= 5) AS rows_written,
           count(*) FILTER (WHERE length(area) > 5) AS rows_rejected,
           count(DISTINCT parcelId) FILTER (WHERE length(area) <= 5) AS keys_upserted
    FROM txk GROUP BY ALL"""
