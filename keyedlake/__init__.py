"""keyedlake: keyed transaction streams on Spark.

JSON messages (Kafka or files) are parsed into typed transaction rows and
upserted into either a versioned, partitioned lake table (copy-on-write or
merge-on-read, with snapshot / time-travel / incremental / read-optimised
reads, compaction and retention) or a relational current-state table
(last arrival wins).  Everything is ordinary DataFrame / SQL work.
"""

__version__ = "0.1.0"
