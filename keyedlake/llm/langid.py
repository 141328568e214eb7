"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text is built.  A text is parsed
left to right into the longest phrases that occur in that training text; the
fewer phrases a byte of text needs, the closer the language (the Ziv-Merhav
estimate of cross entropy).  Phrases are normalised by the training text's size,
``phrases * log2(training bytes) / parsed bytes``, and the language of least cost
wins (ties: the smallest name).

Texts are folded first: letters are lower-cased, every run of other characters is
one space.  The folded bytes of a text are parsed in blocks of ``BLOCK`` bytes,
each begun anew, so that a task parses thousands of blocks side by side as array
operations; each byte of a text belongs to one block.

Training takes, per language, labelled texts of least id hash up to ``TRAIN_BYTES``
in total (a documented bound: the automata are broadcast and must stay small), and
from one text more than an eighth of that only if the others do not fill it.  Every
labelled language is learned; ``AT_ONCE`` of them are broadcast together, so with
more languages the texts are parsed in several scans and each row's costs compared.
Every text is predicted whole.

Defined results
---------------
* null text and text without a letter: ``und`` with score 0;
* rows without a language, with null text or without a letter teach nothing; a
  table without any labelled text gives ``und`` for all;
* repeated rows are predicted alike; further columns are ignored; an empty table
  gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, share, shared, slices, staged

#: Bytes of labelled text per language.
TRAIN_BYTES = 48_000
#: Languages whose automata are broadcast together.
AT_ONCE = 16
#: Bytes of a text that are parsed as one block.
BLOCK = 512

UNDETERMINED = "und"
_NOT_LETTERS = re.compile(r"[\W\d_]+")
_SLICE = 1 << 20


def folded(text: str | None) -> bytes:
    """Lower-cased words separated by single spaces, in UTF-8; empty without a letter."""
    if not text:
        return b""
    words = _NOT_LETTERS.sub(" ", text.lower()).strip()
    return f" {words} ".encode("utf-8", "replace") if any(map(str.isalpha, words)) else b""


def suffix_automaton(text: bytes) -> list[dict[int, int]]:
    """Transitions of the automaton that accepts every substring of ``text``."""
    edges: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in text:
        new = len(edges)
        edges.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in edges[p]:
            edges[p][c] = new
            p = link[p]
        if p != -1:
            q = edges[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                copy = len(edges)
                edges.append(dict(edges[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and edges[p].get(c) == q:
                    edges[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return edges


class Parser:
    """All languages' automata as transition tables over a joint byte alphabet."""

    def __init__(self, samples: dict[str, bytes]):
        self.languages = sorted(samples)
        used = sorted(set(b"".join(samples.values())))
        self.symbol = np.full(256, len(used), np.int32)
        self.symbol[used] = np.arange(len(used), dtype=np.int32)
        self.width = len(used) + 1  # the last symbol occurs in no training text
        self.tables, self.unit = [], []
        for name in self.languages:
            edges = suffix_automaton(samples[name])
            # entries are rows' offsets; -1: no longer match
            table = np.full(len(edges) * self.width, -1, np.int32)
            for state, out in enumerate(edges):
                for c, to in out.items():
                    table[state * self.width + self.symbol[c]] = to * self.width
            self.tables.append(table)
            self.unit.append(float(np.log2(len(samples[name]) + 1)))

    def phrases(self, blocks: np.ndarray, sizes: np.ndarray, table: np.ndarray) -> np.ndarray:
        """Phrases of each block; ``blocks``: symbols by (position, block), longest first."""
        count = np.zeros(blocks.shape[1], np.int64)
        state = np.zeros(blocks.shape[1], np.int32)
        active = np.searchsorted(-sizes, -np.arange(blocks.shape[0]), side="left")
        for t in range(blocks.shape[0]):
            n = active[t]
            symbols = blocks[t, :n]
            to = table[state[:n] + symbols]
            ended = np.flatnonzero(to < 0)
            if len(ended):
                count[ended] += state[ended] > 0  # a phrase ends before this symbol
                again = table[symbols[ended]]
                count[ended] += again < 0  # an unknown symbol is a phrase by itself
                to[ended] = np.maximum(again, 0)
            state[:n] = to
        return count + (state > 0)

    def costs(self, texts: list[bytes]) -> np.ndarray:
        """Bits per byte of every text in every language, by (text, language)."""
        sizes = np.array([len(t) for t in texts], np.int64)
        starts = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(texts)), -(-sizes // BLOCK))
        first = np.concatenate([np.arange(s, s + n, BLOCK) for s, n in zip(starts, sizes)] or [[]]).astype(np.int64)
        length = np.minimum(BLOCK, (starts + sizes)[owner] - first)
        order = np.argsort(-length, kind="stable")
        owner, first, length = owner[order], first[order], length[order]
        data = np.concatenate([self.symbol[np.frombuffer(b"".join(texts), np.uint8)], np.zeros(BLOCK, np.int32)])
        blocks = data[first[None, :] + np.arange(length[0] if len(length) else 0)[:, None]]
        out = np.zeros((len(texts), len(self.tables)))
        for k, table in enumerate(self.tables):
            found = np.bincount(owner, self.phrases(blocks, length, table), minlength=len(texts))
            out[:, k] = found * self.unit[k] / np.maximum(sizes, 1)
        return out


def _fold_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [folded(t) for t in batch.column("text").to_pylist()]
        yield pa.record_batch([batch.column("lang"), batch.column("hash"), pa.array(texts, pa.binary())],
                              names=["lang", "hash", "folded"])


def training_samples(labelled: DataFrame, train_bytes: int = TRAIN_BYTES) -> dict[str, bytes]:
    """Folded text per language: whole texts in order of id hash, cut at ``train_bytes``.

    A first pass counts each language's texts and bytes; a second takes a share of
    the hash range that holds about twice the bound, so only that much is sorted.
    """
    rows = labelled.filter("lang is not null and text is not null").select(
        "lang", "text", F.xxhash64("doc_id").alias("hash"))
    sizes = (rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
             .filter("bytes > 0").orderBy("lang").collect())
    if not sizes:
        return {}
    # at least 40 texts, as a single one may be short
    parts = [(r["lang"], min(1.0, max(2 * train_bytes / r["bytes"], 40 / r["n"]))) for r in sizes]
    shares = labelled.sparkSession.createDataFrame(parts, "lang string, share double")
    chosen = (rows.join(F.broadcast(shares), "lang")
              .filter(F.abs(F.col("hash") % F.lit(1 << 40)) < F.col("share") * F.lit(float(1 << 40)))
              .select("lang", "text", "hash"))
    chosen = staged(arrow_map(chosen, _fold_batches, "lang string, hash long, folded binary"), "langid-sample")
    out: dict[str, bytes] = {}
    for r in sizes:
        taken = rest = b""
        for row in chosen.filter(F.col("lang") == r["lang"]).orderBy("hash", "folded").toLocalIterator():
            text = bytes(row["folded"])
            taken += text[:train_bytes // 8]
            rest += text[train_bytes // 8:][:train_bytes - min(len(rest), train_bytes)]
            if len(taken) >= train_bytes:
                break
        if taken.strip():
            out[r["lang"]] = (taken + rest)[:train_bytes]
    return out


def _predict(parser):
    def run(batches):
        model = shared(parser)
        for batch in slices(batches, limit=_SLICE):
            texts = [folded(t) for t in batch.column("text").to_pylist()]
            names, scores = [], []
            if model.languages:
                costs = model.costs(texts)
                best = costs.argmin(axis=1)
                for i, text in enumerate(texts):
                    others = np.delete(costs[i], best[i])
                    rival = others.min() if len(others) else 0.0
                    names.append(model.languages[best[i]] if text else UNDETERMINED)
                    known = text and rival > 0
                    scores.append(round(float(1 - costs[i, best[i]] / rival), 6) if known else float(bool(text)))
            else:
                names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
            yield pa.record_batch([batch.column("doc_id"), pa.array(names, pa.string()),
                                   pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])
    return run


def _costs(parser):
    """Of the parser's languages the one of least cost, that cost and the next one's, by row."""
    def run(batches):
        model = shared(parser)
        for batch in slices(batches, limit=_SLICE):
            texts = [folded(t) for t in batch.column("text").to_pylist()]
            costs = model.costs(texts)
            best = costs.argmin(axis=1)
            least = np.sort(np.pad(costs, ((0, 0), (0, 1)), constant_values=np.inf), axis=1)[:, :2]
            yield pa.record_batch([batch.column("row"), batch.column("doc_id"), pa.array([bool(t) for t in texts]),
                                   pa.array([model.languages[b] for b in best], pa.string()),
                                   pa.array(least[:, 0]), pa.array(least[:, 1])],
                                  names=["row", "doc_id", "known", "lang", "cost", "rival"])
    return run


def identify(docs: DataFrame, labelled: DataFrame, train_bytes: int = TRAIN_BYTES) -> DataFrame:
    """Per row of ``docs``: doc_id, lang_pred, score; ``labelled`` (doc_id, text, lang) teaches."""
    samples = training_samples(labelled, train_bytes)
    send = partial(share, docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if len(samples) <= AT_ONCE:
        return arrow_map(texts, _predict(send(Parser(samples))), "doc_id long, lang_pred string, score double")
    names = sorted(samples)
    texts = staged(texts.withColumn("row", F.monotonically_increasing_id()), "langid-texts")
    found = None
    for k in range(0, len(names), AT_ONCE):
        parser = send(Parser({name: samples[name] for name in names[k:k + AT_ONCE]}))
        part = staged(arrow_map(texts, _costs(parser), "row long, doc_id long, known boolean, lang string, "
                                                       "cost double, rival double"), "langid-costs")
        parser.unpersist()
        found = part if found is None else found.unionByName(part)
    best = F.min(F.struct("cost", "lang"))
    costs = F.sort_array(F.flatten(F.collect_list(F.array("cost", "rival"))))
    rows = found.groupBy("row", "doc_id", "known").agg(best.alias("best"), costs[1].alias("rival"))
    score = F.when(~F.col("known"), 0.0).when(F.col("rival") > 0, F.round(1 - F.col("best.cost") / F.col("rival"), 6))
    return rows.select("doc_id", F.when(F.col("known"), F.col("best.lang")).otherwise(UNDETERMINED).alias("lang_pred"),
                       score.otherwise(1.0).alias("score"))
