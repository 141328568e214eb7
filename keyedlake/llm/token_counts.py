"""Edit-aware token counts over pre-token segment trees.

A document's *tree* cuts its text into leaves of whole pre-tokens (at least
``LEAF_CHARS`` code points each) and keeps, per leaf, its code points and its
tokens, and above them the sums of each pair of nodes up to the root.  The root
is the document's token count.

An edit replaces ``[begin, end)`` by other text.  Only the leaves that it touches
and the boundary context around them are cut and encoded again: re-encoding
starts at the last leaf that ends ``CONTEXT`` code points before the edit (a
pre-token's match looks no further than that past its end) and goes on until a
new pre-token boundary falls on an old leaf boundary behind the edit, from where
on text and cuts are unchanged.  If the number of leaves stays, the sums of the
paths above the touched leaves are updated in place; else the levels are summed
again from the leaves' counts, without reading text.

Trees are kept: ``plant`` builds those of a table of documents, to be written as Parquet with the texts, and
``update`` joins an edit table to them and returns the table with the edited rows' texts and trees
replaced; documents without edits aren't cut or encoded, and of the others only what their edits
touch.  A tree's stored form is its leaves; the sums above are made from them without reading text.

The pre-token cache of a task holds at most ``REMEMBERED`` words.

Defined results
---------------
* null text is the empty text (one empty leaf, count 0); positions beyond the text
  are cut to its length, a null or negative begin is 0, a null end is begin, null
  replacement is empty; an end before begin counts as begin;
* edits of one document apply in the order of their array, each on the outcome of
  those before; no edits (or a null array) leave the tree as it is;
* repeated rows are counted each by themselves; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import load_ranks
from .common import arrow_map, slices

LEAF_CHARS = 256
#: Code points past its end that decide where a pre-token ends.
CONTEXT = 4
REMEMBERED = 300_000
_SLICE = 2 << 20

EDITS = "array<struct<begin:long,end:long,replacement:string>>"


class Counter:
    """Tokens of pre-tokens, remembered."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex
        import tiktoken

        self.cut = regex.compile(pattern)
        self.bpe = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, int] = {}

    def count(self, words: list[str]) -> int:
        known = self.known
        for w in [w for w in set(words) if w not in known]:
            known[w] = len(self.bpe.encode_ordinary(w))
        total = sum(map(known.__getitem__, words))
        if len(known) > REMEMBERED:
            known.clear()
        return total


class Tree:
    """Leaves' code points and tokens, and the levels of sums above the tokens."""

    def __init__(self, sizes: list[int], tokens: list[int]):
        self.sizes, self.levels = sizes, [tokens]
        self._sum_up()

    def _sum_up(self) -> None:
        del self.levels[1:]
        while len(below := self.levels[-1]) > 1:
            self.levels.append([sum(below[i:i + 2]) for i in range(0, len(below), 2)])

    @property
    def total(self) -> int:
        return self.levels[-1][0]

    def replace(self, first: int, last: int, sizes: list[int], tokens: list[int]) -> None:
        """Put new leaves in place of leaves [first, last)."""
        same = last - first == len(sizes)
        self.sizes[first:last], self.levels[0][first:last] = sizes, tokens
        if not same:
            self._sum_up()
            return
        for below, level in zip(self.levels, self.levels[1:]):
            first, last = first // 2, (last + 1) // 2
            for i in range(first, last):
                level[i] = sum(below[2 * i:2 * i + 2])


def _leaves(text: str, begin: int, counter: Counter, stops: list[int]) -> tuple[list[int], list[int], int]:
    """Cut ``text`` from ``begin`` into leaves until a leaf ends at one of ``stops`` (sorted)
    or the text does; their code points, tokens and the end."""
    sizes, tokens, words, start = [], [], [], begin
    stop_at = set(stops)
    at = begin
    for match in counter.cut.finditer(text, begin):
        words.append(match.group())
        at = match.end()
        if at in stop_at or at - start >= LEAF_CHARS:
            sizes.append(at - start)
            tokens.append(counter.count(words))
            words, start = [], at
            if at in stop_at:
                return sizes, tokens, at
    if words or not sizes:
        sizes.append(len(text) - start)
        tokens.append(counter.count(words))
    return sizes, tokens, len(text)


def build(text: str, counter: Counter) -> Tree:
    sizes, tokens, words, size = [], [], [], 0
    for word in counter.cut.findall(text):
        words.append(word)
        size += len(word)
        if size >= LEAF_CHARS:
            sizes.append(size)
            tokens.append(counter.count(words))
            words, size = [], 0
    if words or not sizes:
        sizes.append(size)
        tokens.append(counter.count(words))
    return Tree(sizes, tokens)


def apply_edit(text: str, tree: Tree, counter: Counter, begin: int | None, end: int | None,
               replacement: str | None) -> tuple[str, int]:
    """The edited text and how many code points were encoded again; ``tree`` is updated."""
    begin = min(max(begin or 0, 0), len(text))
    end = min(max(begin if end is None else end, begin), len(text))
    replacement = replacement or ""
    edited = text[:begin] + replacement + text[end:]
    bounds = np.concatenate([[0], np.cumsum(tree.sizes)]).tolist()
    first = max(0, bisect.bisect_right(bounds, begin - CONTEXT) - 1)
    first = min(first, len(tree.sizes) - 1)
    moved = begin + len(replacement) - end
    # boundaries behind the edit, at their places in the edited text; not the text's end
    behind = bisect.bisect_left(bounds, max(end, bounds[first] + 1))
    stops = [b + moved for b in bounds[behind:-1]]
    sizes, tokens, at = _leaves(edited, bounds[first], counter, stops)
    last = min(bisect.bisect_left(bounds, at - moved, behind), len(tree.sizes)) if at < len(edited) else len(tree.sizes)
    if sizes == [0] and first:  # everything behind the first leaves was deleted
        sizes, tokens = [], []
    tree.replace(first, last, sizes, tokens)
    return edited, at - bounds[first]


def _recount(ranks, pattern: str):
    def run(batches):
        counter = None
        names = ("doc_id", "n_tokens_before", "n_tokens", "n_edits", "n_chars", "reencoded_chars")
        for batch in slices(batches, limit=_SLICE):
            counter = counter or Counter(ranks.value, pattern)
            rows = []
            for doc_id, text, edits in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "edits"))):
                text, edits, again = text or "", edits or [], 0
                tree = build(text, counter)
                before = tree.total
                for e in edits:
                    text, n = apply_edit(text, tree, counter, e["begin"], e["end"], e["replacement"])
                    again += n
                rows.append((doc_id, before, tree.total, len(edits), len(text), again))
            yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)
    return run


def recount(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Token counts of ``docs`` (doc_id, text, edits) before and after the edits.

    Returns doc_id, n_tokens_before, n_tokens, n_edits, n_chars (after the edits) and
    reencoded_chars, the code points that the edits made it encode again.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(load_ranks(path))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.col("edits").cast(EDITS).alias("edits"))
    return arrow_map(rows, _recount(ranks, pattern),
                     "doc_id long, n_tokens_before long, n_tokens long, n_edits long, n_chars long, "
                     "reencoded_chars long")


_TREE = "doc_id long, text string, sizes array<int>, tokens array<int>, n_tokens long"


def _tree_rows(rows: list[tuple]) -> list[pa.Array]:
    types = [pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int64()]
    return [pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * len(types), types)]


def _plant(ranks, pattern: str):
    def run(batches):
        counter = None
        for batch in slices(batches, limit=_SLICE):
            counter = counter or Counter(ranks.value, pattern)
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                tree = build(text or "", counter)
                rows.append((doc_id, text, tree.sizes, tree.levels[0], tree.total))
            yield pa.record_batch(_tree_rows(rows), names=["doc_id", "text", "sizes", "tokens", "n_tokens"])
    return run


def _update(ranks, pattern: str):
    def run(batches):
        counter = None
        names = ("doc_id", "text", "sizes", "tokens", "edits")
        for batch in slices(batches, limit=_SLICE):
            counter = counter or Counter(ranks.value, pattern)
            rows, encoded = [], []
            for doc_id, text, sizes, tokens, edits in zip(*(batch.column(c).to_pylist() for c in names)):
                text, tree, again = text or "", Tree(sizes, tokens), 0
                for e in edits:
                    text, n = apply_edit(text, tree, counter, e["begin"], e["end"], e["replacement"])
                    again += n
                rows.append((doc_id, text, tree.sizes, tree.levels[0], tree.total))
                encoded.append(again)
            yield pa.record_batch([*_tree_rows(rows), pa.array(encoded, pa.int64())],
                                  names=["doc_id", "text", "sizes", "tokens", "n_tokens", "reencoded_chars"])
    return run


def plant(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Trees of ``docs`` (doc_id, text): doc_id, text, sizes and tokens of the leaves, n_tokens."""
    ranks = docs.sparkSession.sparkContext.broadcast(load_ranks(path))
    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), _plant(ranks, pattern), _TREE)


def update(trees: DataFrame, edits: DataFrame, path: str, pattern: str) -> DataFrame:
    """``trees`` after ``edits`` (doc_id, edits: an array as ``recount`` takes it), with reencoded_chars.

    A row of ``edits`` applies to every tree of its id; ids without a tree and null ids are left out.
    Several rows of one id apply one after the other, in the order of their arrays' text.
    """
    ranks = trees.sparkSession.sparkContext.broadcast(load_ranks(path))
    edits = (edits.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("edits").cast(EDITS).alias("edits"))
             .filter("doc_id is not null and size(edits) > 0").groupBy("doc_id")
             .agg(F.flatten(F.array_sort(F.collect_list("edits"))).alias("edits")))
    trees = trees.select("doc_id", "text", "sizes", "tokens", "n_tokens")
    touched = arrow_map(trees.join(edits, "doc_id"), _update(ranks, pattern), _TREE + ", reencoded_chars long")
    same = trees.join(edits.select("doc_id"), "doc_id", "left_anti").withColumn("reencoded_chars", F.lit(0).cast("long"))
    return touched.unionByName(same)


def derived_edits(doc_id: Column, text: Column, source: Column) -> Column:
    """Three edits of a row made from its own columns: an insertion of the source name,
    the deletion of twelve code points and the replacement of five by a date-like number,
    at places given by hashes of the id."""
    size = F.coalesce(F.length(text), F.lit(0)) + 1
    place = [F.pmod(F.xxhash64(doc_id, F.lit(k)), size.cast("long")) for k in range(3)]
    number = F.format_string(" %04d-%02d", F.pmod(doc_id, F.lit(10000)), F.pmod(doc_id, F.lit(12)) + 1)
    edit = lambda at, n, put: F.struct(at.alias("begin"), (at + n).alias("end"), put.alias("replacement"))
    return F.array(edit(place[0], 0, F.coalesce(source, F.lit(""))), edit(place[1], 12, F.lit("")),
                   edit(place[2], 5, F.coalesce(number, F.lit(""))))
