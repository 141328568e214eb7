"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The alphabet is words, not characters: A-Z are lower-cased and every byte that
is no ASCII letter, digit or part of a non-ASCII character separates words.
Patterns are all windows of ``window`` consecutive words of each benchmark item
(an item of fewer words is one pattern).  For each pattern length m

* the *shift* table tells for a block of two words how far the search may move
  on without passing over an occurrence (unknown block: m - 1 words),
* blocks that end a pattern (shift 0) select the bucket of patterns with that
  suffix, whose candidates are compared word by word.

The benchmark is a query set: it is taken in blocks of at most ``block_bytes``
of text, each broadcast within that bound, and the documents pass through one
search per block without a shuffle.

Defined results
---------------
* null and word-less texts have no words and no hits; a word-less item has no
  pattern; repeated items and repeated documents each count by themselves (items
  that share an ``item_id`` count once); a null ``item_id`` is no item;
* overlapping occurrences all count; a word is hit once;
* an empty benchmark or document table gives no hits or no rows; further columns
  of ``docs`` are ignored by ``find_hits`` and kept by ``drop_contaminated``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, share, shared

WINDOW = 10
#: Bytes of benchmark text whose tables are broadcast at once.
BLOCK_BYTES = 8 << 20

#: Byte table: lower-case A-Z, blank out what separates words.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
              for b in range(256))


def words_of(text: str | bytes | None) -> list[bytes]:
    if not text:
        return []
    raw = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text
    return raw.translate(_FOLD).split()


class WuManber:
    """Shift and suffix tables for the word windows of a block of items."""

    def __init__(self, items: list[tuple[int, str | None]], window: int = WINDOW):
        by_length: dict[int, dict[tuple[bytes, ...], set[int]]] = {}
        for item_id, text in items:
            words = words_of(text)
            m = min(window, len(words))
            for i in range(len(words) - m + 1 if m else 0):
                by_length.setdefault(m, {}).setdefault(tuple(words[i:i + m]), set()).add(item_id)
        self.tables = []
        for m, patterns in sorted(by_length.items()):
            shift: dict[bytes, int] = {}
            bucket: dict[bytes, list[tuple[list[bytes], list[int]]]] = {}
            width = min(2, m)
            for pattern, ids in patterns.items():
                for end in range(width, m + 1):
                    block = b" ".join(pattern[end - width:end])
                    shift[block] = min(shift.get(block, m), m - end)
                bucket.setdefault(b" ".join(pattern[m - width:]), []).append((list(pattern), sorted(ids)))
            self.tables.append((m, width, m - width + 1, shift, bucket))

    def search(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Occurrences as (begin, end) word spans, and the items that have one."""
        spans, items = [], set()
        n = len(words)
        for m, width, most, shift, bucket in self.tables:
            i = m - 1
            while i < n:
                block = words[i - 1] + b" " + words[i] if width == 2 else words[i]
                step = shift.get(block, most)
                if step:
                    i += step
                    continue
                begin = i - m + 1
                for pattern, ids in bucket[block]:
                    if words[begin:i + 1] == pattern:
                        spans.append((begin, i + 1))
                        items.update(ids)
                i += 1
        return spans, items


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[int, str]]]:
    """The benchmark in blocks of bounded size, one in the driver at a time."""
    block, size = [], 0
    rows = benchmark.select("item_id", "text").filter("item_id is not null and text is not null")
    for row in rows.toLocalIterator():
        block.append((row.item_id, row.text))
        size += len(row.text)
        if size >= block_bytes:
            yield block
            block, size = [], 0
    if block:
        yield block


_SPAN = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
_OPEN = "doc_id long, text string, spans array<struct<begin:long,end:long>>, items array<long>"
_DONE = ("doc_id long, n_words long, n_hit long, n_items long, items array<long>, "
         "hits array<struct<begin:long,end:long>>, items_sha256 string")


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    runs: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if runs and begin <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(runs[-1][1], end))
        else:
            runs.append((begin, end))
    return runs


def _search_pass(matcher, last: bool):
    """Search one block of items; the last pass leaves the text behind and sums up."""
    def rows(batch, search):
        texts = batch.column("text").cast(pa.binary())
        before = zip(batch.column("doc_id").to_pylist(), batch.column("spans").to_pylist(),
                     batch.column("items").to_pylist())
        for k, (doc_id, spans, items) in enumerate(before):
            words = words_of(texts[k].as_py())
            spans, ids = [(s["begin"], s["end"]) for s in spans], set(items)
            if search is not None and words:
                found, more = search(words)
                spans, ids = spans + found, ids | more
            yield doc_id, len(words), _merged(spans), sorted(ids)

    def run(batches):
        search = None if matcher is None else shared(matcher).search
        for batch in batches:
            ids, n_words, spans, items = map(list, zip(*rows(batch, search)))
            hits = pa.array([[{"begin": a, "end": b} for a, b in x] for x in spans], _SPAN)
            found = pa.array(items, pa.list_(pa.int64()))
            if not last:
                yield pa.record_batch([pa.array(ids, pa.int64()), batch.column("text"), hits, found],
                                      names=["doc_id", "text", "spans", "items"])
                continue
            digests = [hashlib.sha256(",".join(sorted(map(str, x))).encode()).hexdigest() for x in items]
            yield pa.record_batch(
                [pa.array(ids, pa.int64()), pa.array(n_words, pa.int64()),
                 pa.array([sum(b - a for a, b in x) for x in spans], pa.int64()),
                 pa.array(map(len, items), pa.int64()), found, hits, pa.array(digests, pa.string())],
                names=["doc_id", "n_words", "n_hit", "n_items", "items", "hits", "items_sha256"])

    def checked(batches):
        return run(b for b in batches if b.num_rows)
    return checked


def find_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
              block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, items (ids), hits (merged
    word spans, end exclusive), items_sha256."""
    spark = docs.sparkSession
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                        F.expr("cast(array() as array<struct<begin:long,end:long>>)").alias("spans"),
                        F.expr("cast(array() as array<long>)").alias("items"))
    blocks = _blocks(benchmark, block_bytes)
    block = next(blocks, None)
    while True:
        later = next(blocks, None)
        matcher = share(spark, WuManber(block, window)) if block else None
        found = arrow_map(found, _search_pass(matcher, later is None), _DONE if later is None else _OPEN)
        if later is None:
            return found
        block = later


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                      block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark window; all columns stay, no shuffle."""
    def clean(matcher):
        def run(batches):
            search = shared(matcher).search
            for batch in batches:
                texts = batch.column("text").cast(pa.binary())
                found = [bool(search(words_of(t.as_py()))[0]) for t in texts]
                yield batch.filter(pa.array([not f for f in found], pa.bool_()))
        return run

    for block in _blocks(benchmark, block_bytes):
        docs = arrow_map(docs, clean(share(docs.sparkSession, WuManber(block, window))), docs.schema)
    return docs
