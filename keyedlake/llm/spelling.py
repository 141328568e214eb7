"""Spelling variants: k-d trees over letter-count vectors find words that are one edit apart.

A replaced letter changes two counts by one, an inserted or deleted one changes one: words that
are one edit apart lie within L1 distance 2 (equal lengths) or 1 (lengths L and L + 1).

1. Words are counted: tasks fold them first, then one shuffle by word.
2. For each length a k-d tree, grown from a bounded sample of words, cuts the count vectors into
   cells.  Every word lives in the one cell that holds its vector and is also sent, as
   a query, to the cells that its ball touches: of its own length those after its
   own cell (radius 2), of the next length all (radius 1), so that each pair meets once.
3. In its cell a task grows a finer tree over the cell's words and streams the queries through
   it.  A box is passed over when it is further off than the radius; in the leaves that
   remain, the letter counts (as bit sets) and then the letters in order are compared.
   Both words of a pair are told, folded by cell and then by word.
4. Roots follow forms by pointer jumping; a form has ten times the word's count, so chains
   are short.

The sample shapes the cells only; every word is searched.  Words of a cell are
bounded by its share of letters, except anagrams of each other, which no tree over counts
parts; those are compared in blocks.

Defined results
---------------
* null and empty texts have no words; a null doc_id hashes as the empty string;
* repeated rows count again; a run of any length is one word;
* no words, or an empty table, give no rows; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, slices, staged

#: Letters that a cell holds, the most cells, and words sampled for each cell.
CELL_LETTERS, MOST_CELLS, SAMPLES = 1 << 17, 4096, 20
#: Words of a leaf within a cell.
LEAF = 32
#: Distinct words that a task counts before it passes them on; letters compared at a time.
FOLDED, COMPARED = 1 << 20, 1 << 24

# The letters of words, the least length, the share of runs with a deletion.
SHORTEST, ONE_IN, LEADS = 7, 31, 10
_RUN = re.compile("[A-Za-zÀ-ÿ]{%d,}" % SHORTEST)
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: a to z and U+00C0 to U+00FF as dimensions of the count vectors.
_DIMS = 26 + 64
_DIM = np.array([c - 97 if 97 <= c < 123 else 26 + c - 0xC0 if c >= 0xC0 else 0 for c in range(256)], np.int64)

_COUNT = "word string, n bigint"
_SENT = "cell string, query boolean, word string, n bigint"
_NEAR = "word string, n_near bigint, best struct<low: bigint, form: string>"


# ------------------------------------------------------------------ words
def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def flush() -> pa.RecordBatch:
        out = pa.record_batch([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                              names=["word", "n"])
        counts.clear()
        return out

    for batch in slices(batches):
        ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()
        for doc_id, text in zip(ids, texts):
            if not text:
                continue
            lead = zlib.crc32(b"%s:" % (b"" if doc_id is None else b"%d" % doc_id))
            for word, n in Counter(_RUN.findall(text.translate(_LOWER).decode())).items():
                h = zlib.crc32(word.encode(), lead)
                if h % ONE_IN == 0:
                    at = h % len(word)
                    word = word[:at] + word[at + 1:]
                    if len(word) < SHORTEST:
                        continue
                counts[word] += n
            if len(counts) > FOLDED:
                yield flush()
    if counts:
        yield flush()


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of the words that occur at least twice."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return arrow_map(rows, _counted, _COUNT).groupBy("word").agg(F.sum("n").alias("n")).filter("n >= 2")


# ------------------------------------------------------------------ trees
def _codes(words: list[str]) -> np.ndarray:
    """Letters of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def _vectors(codes: np.ndarray) -> np.ndarray:
    rows = np.arange(len(codes))[:, None] * _DIMS
    return np.bincount((rows + _DIM[codes]).ravel(), minlength=len(codes) * _DIMS).reshape(-1, _DIMS).astype(np.int32)


def grow(vectors: np.ndarray, leaf: int) -> list[tuple]:
    """A k-d tree as a list of nodes: (dim, threshold, left, right), or (-1, leaf number, members, None).

    Each node is cut where the letter's mean parts its members most evenly; a node whose
    members all have one vector is a leaf however many there are.
    """
    nodes: list = [None]
    todo, leaves = [(0, np.arange(len(vectors)))], 0
    while todo:
        at, members = todo.pop()
        own = vectors[members]
        split = None
        if len(members) > leaf:
            bounds = own.mean(0).astype(np.int64)  # floor
            share = (own > bounds).mean(0)
            dim = int(np.abs(share - 0.5).argmin())
            if 0 < share[dim] < 1:
                split = dim, int(bounds[dim])
        if split is None:
            nodes[at] = (-1, leaves, members, None)
            leaves += 1
            continue
        above = own[:, split[0]] > split[1]
        nodes[at] = (*split, len(nodes), len(nodes) + 1)
        todo += [(len(nodes), members[~above]), (len(nodes) + 1, members[above])]
        nodes += [None, None]
    return nodes


def visit(nodes: list[tuple], vectors: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(leaf number, its members, queries whose ball touches its box, their L1 distances to the box)."""
    todo = [(0, np.arange(len(vectors)), np.zeros(len(vectors), np.int32), {})]
    while todo:
        at, asks, far, box = todo.pop()
        dim, threshold, left, right = nodes[at]
        if dim < 0:
            yield threshold, left, asks, far
            continue
        low, high = box.get(dim, (0, 1 << 30))
        x = vectors[asks, dim]
        before = np.maximum(np.maximum(low - x, x - high), 0)
        for child, (a, b) in ((left, (low, threshold)), (right, (threshold + 1, high))):
            d = far - before + np.maximum(np.maximum(a - x, x - b), 0)
            near = d <= radius
            if near.any():
                todo.append((child, asks[near], d[near], {**box, dim: (a, b)}))


# ------------------------------------------------------------------ cells
def _trees(words: DataFrame) -> dict[int, list[tuple]]:
    """By length, a tree whose leaves are cells; lengths without one are a single cell.

    At most about SAMPLES * MOST_CELLS words and MOST_CELLS lengths pass the driver.
    """
    length = F.length("word")
    total = words.agg(F.count("*").alias("n"), F.sum(length).alias("letters")).first()
    size = max(CELL_LETTERS, (total["letters"] or 0) // MOST_CELLS)
    wide = [r["l"] for r in words.groupBy(length.alias("l")).agg(F.count("*").alias("n"))
            .filter(F.col("n") * F.col("l") > size).collect()]
    if not wide:
        return {}
    share = min(1.0, SAMPLES * (total["letters"] / size) / total["n"])
    drawn = words.filter(length.isin(wide) & (F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < int(share * (1 << 20))))
    by_length: dict[int, list[str]] = {}
    for row in drawn.select("word").collect():
        by_length.setdefault(len(row["word"]), []).append(row["word"])
    per_cell = {n: max(1, int(size / n * share)) for n in by_length}
    return {n: [(d, t, *((None, None) if d < 0 else (a, b))) for d, t, a, b in grow(_vectors(_codes(w)), per_cell[n])]
            for n, w in by_length.items()}


def _send(trees: dict[int, list[tuple]]):
    """Each word to its own cell, and as a query to the cells after it that its ball touches."""
    one_cell = [(-1, 0, None, None)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("word").to_pylist()
            sizes = np.array([len(w) for w in words])
            cells, queries, taken = [], [], []

            def add(cell: str, query: bool, at: np.ndarray) -> None:
                cells.extend([cell] * len(at))
                queries.extend([query] * len(at))
                taken.append(at)

            for n in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == n)
                step = max(1, COMPARED // (n + _DIMS * 4))
                for some in (at[i:i + step] for i in range(0, len(at), step)):
                    v = _vectors(_codes([words[i] for i in some]))
                    own = np.empty(len(some), np.int64)
                    touched = []
                    for cell, _, asks, far in visit(trees.get(n, one_cell), v, 2):
                        own[asks[far == 0]] = cell
                        touched.append((cell, asks))
                    for cell, asks in touched:
                        add(f"{n}:{cell}", False, some[asks[own[asks] == cell]])
                        add(f"{n}:{cell}", True, some[asks[own[asks] < cell]])
                    for cell, _, asks, _ in visit(trees.get(n + 1, one_cell), v, 1):
                        add(f"{n + 1}:{cell}", True, some[asks])
            at = pa.array(np.concatenate(taken))
            yield pa.record_batch([pa.array(cells, pa.string()), pa.array(queries, pa.bool_()),
                                   batch.column("word").take(at), batch.column("n").take(at)],
                                  names=["cell", "query", "word", "n"])
    return run


def _bits(vectors: np.ndarray) -> np.ndarray:
    """Bit sets of (letter, at least once) and (letter, at least twice): they differ in no more bits than counts do."""
    flags = np.zeros((len(vectors), 192), bool)
    flags[:, :_DIMS], flags[:, _DIMS:2 * _DIMS] = vectors > 0, vectors > 1
    return np.packbits(flags, axis=1, bitorder="little").view(np.uint64)


def _one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of a and b (as long or one longer) are one edit apart."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(1) == 1
    n = a.shape[1]
    head = np.logical_and.accumulate(a == b[:, :n], axis=1).sum(1)
    tail = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(1)
    return head + tail >= n


class _Cell:
    """The words of one cell, and what pairs tell of them."""

    def __init__(self, words: list[str], n: list[int]):
        self.words, self.n = words, np.array(n, np.int64)
        self.codes = _codes(words)
        self.vectors = _vectors(self.codes)
        self.bits = _bits(self.vectors)
        self.nodes = grow(self.vectors, LEAF)

    def pairs(self, codes: np.ndarray, within: bool) -> tuple[np.ndarray, np.ndarray]:
        """(queries, words) that are one edit apart; ``within``: the queries are the cell's words, each pair once."""
        same = codes.shape[1] == self.codes.shape[1]
        vectors = self.vectors if within else _vectors(codes)
        bits, radius = self.bits if within else _bits(vectors), 2 if same else 1
        found = []
        for _, members, asks, _ in visit(self.nodes, vectors, radius):
            step = max(1, COMPARED // 64 // len(members))
            for some in (asks[i:i + step] for i in range(0, len(asks), step)):
                apart = sum(np.bitwise_count(bits[some, k][:, None] ^ self.bits[members, k][None, :]) for k in range(3))
                q, r = np.nonzero(apart <= radius)
                q, r = some[q], members[r]
                if within:
                    q, r = q[q < r], r[q < r]
                for i in range(0, len(q), max(1, COMPARED // codes.shape[1])):
                    j = i + max(1, COMPARED // codes.shape[1])
                    ok = _one_edit(codes[q[i:j]], self.codes[r[i:j]])
                    found.append((q[i:j][ok], r[i:j][ok]))
        none = np.zeros(0, np.int64)
        return (np.concatenate([none, *(q for q, _ in found)]), np.concatenate([none, *(r for _, r in found)]))


def _told(words: list[str], at: np.ndarray, others: list[str], n: np.ndarray, of: np.ndarray) -> pa.RecordBatch | None:
    """Per word: its number of near words, and the one of them with the largest n, then least in order."""
    if not len(at):
        return None
    used, where = np.unique(of, return_inverse=True)
    rank = np.empty(len(used), np.int64)
    rank[sorted(range(len(used)), key=lambda i: others[used[i]])] = np.arange(len(used))
    order = np.lexsort((rank[where], -n[of], at))
    first = np.flatnonzero(np.concatenate([[True], np.diff(at[order]) != 0]))
    best = of[order][first]
    return pa.RecordBatch.from_pydict({
        "word": pa.array([words[i] for i in at[order][first]], pa.string()),
        "n_near": pa.array(np.diff(np.append(first, len(order))), pa.int64()),
        "best": pa.StructArray.from_arrays([pa.array(-n[best], pa.int64()), pa.array([others[i] for i in best], pa.string())],
                                           names=["low", "form"])})


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by cell, its words before its queries."""
    name, words, n, cell = None, [], [], None
    for batch in batches:
        cells, asks = batch.column("cell").to_pylist(), batch.column("query").to_numpy(zero_copy_only=False)
        texts, counts = batch.column("word").to_pylist(), batch.column("n").to_pylist()
        cuts = [0, *(i for i in range(1, len(cells)) if cells[i] != cells[i - 1] or asks[i] != asks[i - 1]), len(cells)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if cells[a] != name:
                yield from _within(cell or words and _Cell(words, n))
                name, words, n, cell = cells[a], [], [], None
            if not asks[a]:
                words += texts[a:b]
                n += counts[a:b]
                continue
            if words and cell is None:
                cell = _Cell(words, n)  # its words are all there: queries come after them
            if cell is not None:
                yield from _asked(cell, texts[a:b], np.array(counts[a:b], np.int64))
    yield from _within(cell or words and _Cell(words, n))


def _within(cell: _Cell | list) -> Iterator[pa.RecordBatch]:
    if cell:
        a, b = cell.pairs(cell.codes, within=True)
        told = _told(cell.words, np.concatenate([a, b]), cell.words, cell.n, np.concatenate([b, a]))
        if told is not None:
            yield told


def _asked(cell: _Cell, texts: list[str], counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    sizes = np.array([len(t) for t in texts])
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == size)
        some = [texts[i] for i in at]
        q, r = cell.pairs(_codes(some), within=False)
        for told in (_told(some, q, cell.words, cell.n, r), _told(cell.words, r, some, counts[at], q)):
            if told is not None:
                yield told


# ------------------------------------------------------------------ forms
def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form, by pointer jumping."""
    roots = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        after = staged(roots.join(onward, "root", "left")
                       .select("word", F.coalesce("further", "root").alias("root"),
                               F.col("further").isNotNull().alias("moved")), "roots")
        roots = after.select("word", "root")
        if after.filter("moved").isEmpty():
            return roots


def spelling_variants(docs: DataFrame) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n."""
    words = staged(vocabulary(docs), "words")
    trees = _trees(words)
    cells = sum(sum(node[0] < 0 for node in t) for t in trees.values())
    # the number of tasks is given: adaptive execution would join them by the size of the rows, which says little here
    met = (arrow_map(words, _send(trees), _SENT).repartition(8 + 2 * cells, "cell")
           .sortWithinPartitions("cell", "query"))
    near = (arrow_map(met, _searched, _NEAR).groupBy("word")
            .agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best")))
    leads = -F.col("best.low") >= LEADS * F.col("n")
    found = staged(words.join(near, "word", "left").select(
        "word", F.when(leads, F.col("best.form")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(leads, -F.col("best.low")).alias("form_n")), "forms")
    roots = _roots(found.filter("form is not null"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"),
                                                    "n", "n_near", "form_n")
