"""Byte-level BPE as recursive DuckDB queries inside Spark tasks.

Encoding.  A text is cut into words by the public pre-tokeniser pattern.  A word
that is a vocabulary entry is that token.  The other distinct words that a task has
not met yet go to an in-memory DuckDB as token position rows, one token a byte at
first.  A recursive query joins neighbours with the merge table and contracts, in
every word at once, the leftmost pair of least rank, until no word has a pair left
(``_ENCODE``).  In words over LONG_WORD bytes, where one pair a round would be slow, a round
contracts all pairs that are least within the longest entry's reach, which gives the same result in
a number of rounds that doesn't grow with the word (``_ROUND``).

Decoding.  Ids are joined with the vocabulary by position and put together with
an ordered aggregation per text (see ``_DECODE``).

The merge table has a row for each way to split a vocabulary entry into two
entries, so it equals the rank files' rule: join the two neighbours whose bytes
together have the least rank.  Vocabulary and merge table have a fixed size.

Words are remembered per task up to ``REMEMBERED`` entries, after which the memory
is begun anew; it only saves work.

Defined results
---------------
* null text is the empty text: no ids, empty decoded bytes;
* a word of any length is encoded whole (100,000 letters take seconds); a long text is many words;
* special tokens' strings in a text are ordinary text;
* ids that the vocabulary lacks decode to nothing; null ids arrays to empty bytes;
* repeated rows are encoded alike; further columns are dropped; an empty table gives
  an empty result.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, sha256_hex, slices

#: Words (with their ids) that one task remembers.
REMEMBERED = 300_000
#: Bytes of new words that one recursive query takes (or one longer word).
GROUP_BYTES = 1 << 18
_SLICE = 2 << 20

#: Words of more bytes than this are contracted by _ROUND.
LONG_WORD = 64

#: A row is a token (a) at its position, the token after it (b, null at the end) and
#: the token that the two would make.  Contracting at position p leaves out row p and
#: renames the pair's token in its neighbours, so a round is one aggregate and two joins.
_ENCODE = """
WITH RECURSIVE step(round, word, pos, a, b, made) AS (
    SELECT 0, w.word, w.pos, w.a, w.b, m.made FROM bytes_of_words w LEFT JOIN merges m ON m.a = w.a AND m.b = w.b
  UNION ALL
    SELECT n.round, n.word, n.pos, n.a, n.b, m.made
    FROM (SELECT s.round + 1 AS round, s.word, s.pos - (s.pos > l.p)::INT AS pos,
                 CASE WHEN s.pos = l.p + 1 THEN l.token ELSE s.a END AS a,
                 CASE WHEN s.pos = l.p - 1 THEN l.token ELSE s.b END AS b
          FROM step s JOIN (SELECT word, (min(made::BIGINT << 32 | pos) & 4294967295)::INT AS p, min(made) AS token
                            FROM step WHERE made IS NOT NULL GROUP BY word) l ON l.word = s.word
          WHERE s.pos <> l.p) n
    LEFT JOIN merges m ON m.a = n.a AND m.b = n.b)
SELECT s.word, list(s.a ORDER BY s.pos) AS ids
FROM step s JOIN (SELECT word, max(round) AS last FROM step GROUP BY word) e ON e.word = s.word AND e.last = s.round
GROUP BY s.word ORDER BY s.word
"""

#: One round for long words, each round a statement of its own as the rounds of a
#: recursion would all stay in memory.  Contracted are all pairs of least rank within the longest
#: entry's bytes on both sides: a token that could take one of their halves away would lie in
#: those bytes and begin with a pair of lesser rank there.  Of pairs of one rank, the left one comes
#: first: if their token is settled, every other pair of a run of neighbours is contracted (where
#: nothing of lesser rank is about the run's begin, which could move it), else a pair that
#: has no equal in those bytes on its left.
_ROUND = """
CREATE OR REPLACE TEMP TABLE contracted AS
SELECT word, (row_number() OVER (PARTITION BY word ORDER BY pos) - 1)::INT AS pos, off, a FROM (
    SELECT word, pos, off, CASE WHEN takes THEN made ELSE a END AS a,
           coalesce(lag(takes) OVER (PARTITION BY word ORDER BY pos), false) AS taken
    FROM (
        SELECT *, coalesce(least_here AND CASE
                      WHEN settled THEN (pos - run_start) % 2 = 0
                                        AND first_value(least_here) OVER (PARTITION BY word, run_start ORDER BY pos)
                      ELSE made < coalesce(least_left, 2147483647) END, false) AS takes
        FROM (
            SELECT *, made <= min(made) OVER (PARTITION BY word ORDER BY off
                                              RANGE BETWEEN {longest} PRECEDING AND {longest} * 2 FOLLOWING) AS least_here,
                   min(made) OVER (PARTITION BY word ORDER BY off RANGE BETWEEN {longest} PRECEDING AND 1 PRECEDING) AS least_left,
                   max(CASE WHEN made IS DISTINCT FROM made_before THEN pos ELSE 0 END)
                          OVER (PARTITION BY word ORDER BY pos ROWS UNBOUNDED PRECEDING) AS run_start
            FROM (
                SELECT p.*, m.made, m.settled, lag(m.made) OVER (PARTITION BY p.word ORDER BY p.pos) AS made_before
                FROM (SELECT *, lead(a) OVER (PARTITION BY word ORDER BY pos) AS b FROM contracting) p
                LEFT JOIN merges m ON m.a = p.a AND m.b = p.b))))
WHERE NOT taken
"""
_COLLECT = "SELECT word, list(a ORDER BY pos) AS ids FROM contracting GROUP BY word ORDER BY word"

_DECODE = """
SELECT p.text, string_agg(v.hex, '' ORDER BY p.pos) AS hex
FROM positions p JOIN vocabulary v ON v.token = p.token GROUP BY p.text
"""


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def merge_table(ranks: dict[bytes, int]) -> dict[str, np.ndarray]:
    """All (a, b, made, settled): neighbours whose bytes together are the entry ``made``."""
    rows = [(ranks[t[:i]], ranks[t[i:]], made) for t, made in ranks.items()
            for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
    a, b, made = np.array(rows or np.empty((0, 3)), np.int32).T
    # least rank of any pair that has the token on either side
    least = np.full(max(ranks.values(), default=0) + 1, np.iinfo(np.int32).max, np.int32)
    np.minimum.at(least, a, made)
    np.minimum.at(least, b, made)
    return {"a": a, "b": b, "made": made, "settled": least[made] >= made}


class Codec:
    """One task's DuckDB with the vocabulary, the merge table and the words met so far."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import duckdb
        import regex

        self.words_of = regex.compile(pattern).findall
        self.whole = {t: int(r).to_bytes(4, "little") for t, r in ranks.items()}
        self.byte_token = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        self.known: dict[str, bytes] = {}
        self.round = _ROUND.format(longest=max(map(len, ranks), default=1))
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "300MB", "temp_directory": ""})
        merges = pa.table(merge_table(ranks))  # noqa: F841 (read by the query)
        self.db.execute("CREATE TABLE merges AS SELECT * FROM merges")
        vocabulary = pa.table({"token": pa.array(ranks.values(), pa.int32()),  # noqa: F841
                               "hex": pa.array([t.hex() for t in ranks], pa.string())})
        self.db.execute("CREATE TABLE vocabulary AS SELECT * FROM vocabulary")

    def _encode_words(self, words: list[bytes]) -> list[bytes]:
        sizes = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(sizes)
        tokens = self.byte_token[np.frombuffer(b"".join(words), np.uint8)]
        after = np.append(tokens[1:], 0)
        last = np.zeros(len(tokens), bool)
        last[ends - 1] = True
        bytes_of_words = pa.table({  # noqa: F841 (read by the query)
            "word": np.repeat(np.arange(len(words)), sizes),
            "pos": (np.arange(len(tokens)) - np.repeat(ends - sizes, sizes)).astype(np.int32),
            "a": tokens, "b": pa.array(after, pa.int32(), mask=last)})
        if sizes.max() <= LONG_WORD:
            found = self.db.sql(_ENCODE)
        else:
            self.db.execute("CREATE OR REPLACE TEMP TABLE contracting AS SELECT word, pos, pos AS off, a FROM bytes_of_words")
            left, before = len(tokens), None
            while left != before:
                self.db.execute(self.round)
                self.db.execute("DROP TABLE contracting; ALTER TABLE contracted RENAME TO contracting")
                left, before = self.db.sql("SELECT count(*) FROM contracting").fetchall()[0][0], left
            found = self.db.sql(_COLLECT)
        ids = found.to_arrow_table().column("ids").combine_chunks()
        flat, ends = np.asarray(ids.values).astype("<u4"), np.asarray(ids.offsets)
        return [flat[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]

    def _learn(self, words: set[str]) -> None:
        """Encode words: vocabulary entries at once, the rest by groups of like length."""
        rest: dict[bytes, str] = {}
        for w in words:
            raw = w.encode("utf-8", "replace")
            if raw in self.whole:
                self.known[w] = self.whole[raw]
            else:
                rest[raw] = w
        group, size = [], 0
        for raw in sorted(rest, key=len) + [None]:
            if group and (raw is None or size + len(raw) > GROUP_BYTES or
                          len(raw) > LONG_WORD and len(raw) > 2 * len(group[0])):
                for done, ids in zip(group, self._encode_words(group)):
                    self.known[rest[done]] = ids
                group, size = [], 0
            if raw is not None:
                group.append(raw)
                size += len(raw)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        cut = [self.words_of(t) if t else [] for t in texts]
        new = {w for words in cut for w in words} - self.known.keys()
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = {w for words in cut for w in words}
        self._learn(new)
        return [b"".join(map(self.known.__getitem__, words)) for words in cut]

    def decode(self, encoded: list[bytes]) -> list[bytes]:
        """Bytes of each sequence of ids."""
        sizes = np.array([len(e) // 4 for e in encoded], np.int64)
        positions = pa.table({"text": np.repeat(np.arange(len(encoded)), sizes),  # noqa: F841
                              "pos": np.arange(sizes.sum()),
                              "token": np.frombuffer(b"".join(encoded), "<u4").astype(np.int32)})
        out = [b""] * len(encoded)
        if len(positions):
            for text, digits in self.db.execute(_DECODE).fetchall():
                out[text] = bytes.fromhex(digits)
        return out


@lru_cache(maxsize=1)
def _ranks(path: str) -> dict[bytes, int]:
    return load_ranks(path)


def _encoded(ranks, pattern: str, finish):
    """Encode batch by batch; ``finish`` turns a batch, the ids' bytes and the task's codec into rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = None
        for batch in slices(batches, limit=_SLICE):
            codec = codec or Codec(ranks.value, pattern)
            yield finish(batch, codec.encode(batch.column("text").to_pylist()), codec)
    return run


def _id_rows(batch: pa.RecordBatch, encoded: list[bytes], codec: Codec) -> pa.RecordBatch:
    ends = np.cumsum([0] + [len(e) // 4 for e in encoded])
    flat = np.frombuffer(b"".join(encoded), "<u4").astype(np.int32)
    return pa.record_batch([batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)],
                           names=["doc_id", "ids"])


def _digest_rows(batch: pa.RecordBatch, encoded: list[bytes], codec: Codec) -> pa.RecordBatch:
    return pa.record_batch([batch.column("doc_id"), pa.array([len(e) // 4 for e in encoded], pa.int64()),
                            pa.array(map(sha256_hex, encoded), pa.string()),
                            pa.array(map(sha256_hex, codec.decode(encoded)), pa.string())],
                           names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def _checked_rows(batch: pa.RecordBatch, encoded: list[bytes], codec: Codec) -> pa.RecordBatch:
    """Ids, and whether they decode to the text's bytes."""
    texts = [(t or "").encode("utf-8", "replace") for t in batch.column("text").to_pylist()]
    same = [a == b for a, b in zip(codec.decode(encoded), texts)]
    rows = _id_rows(batch, encoded, codec)
    return (rows.append_column("n_tokens", pa.array([len(e) // 4 for e in encoded], pa.int64()))
            .append_column("round_trip", pa.array(same, pa.bool_())))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per row of ``docs``: doc_id, ids (array<int>)."""
    ranks = docs.sparkSession.sparkContext.broadcast(_ranks(path))
    return arrow_map(_texts(docs), _encoded(ranks, pattern, _id_rows), "doc_id long, ids array<int>")


def tokenise(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per row of ``docs``: doc_id, ids, n_tokens and whether the ids decode to the text."""
    ranks = docs.sparkSession.sparkContext.broadcast(_ranks(path))
    return arrow_map(_texts(docs), _encoded(ranks, pattern, _checked_rows),
                     "doc_id long, ids array<int>, n_tokens long, round_trip boolean")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode and decode every row: doc_id, n_tokens, SHA-256 of the ids as little-endian
    unsigned 32-bit integers and of the decoded bytes."""
    ranks = docs.sparkSession.sparkContext.broadcast(_ranks(path))
    return arrow_map(_texts(docs), _encoded(ranks, pattern, _digest_rows),
                     "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Per row of ``encoded`` (doc_id, ids): doc_id, decoded (binary)."""
    ranks = encoded.sparkSession.sparkContext.broadcast(_ranks(path))

    def run(batches):
        codec = None
        for batch in batches:
            codec = codec or Codec(ranks.value, "")
            ids = [np.array(x or [], "<u4").tobytes() for x in batch.column("ids").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), pa.array(codec.decode(ids), pa.binary())],
                                  names=["doc_id", "decoded"])

    rows = encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids")
    return arrow_map(rows, run,
                     "doc_id long, decoded binary")
