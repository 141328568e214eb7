"""Quality classifier by importance resampling of hashed n-grams.

Two generative models of hashed byte n-grams are estimated: *raw* from every
document, *target* from the labelled documents of good quality that are not
toxic.  The evidence of an n-gram is

    min(0, log((target + a) / (raw scaled to target's size + a)) + t)

so n-grams that the target holds nearly as often as the raw text are neutral.  A
document's log weight is the least of the mean evidence over its n-grams and of
the least sums over its windows of 32 to 8,192 n-grams, each in units of its own
cut.  No evidence is above 0, so text put before or after a document can raise its
mean but none of its window sums: what a window shows no clean passage outweighs.

``a`` and ``t`` (a pair of ``SHAPES``) and the units are those that part the labelled
documents best: first the windows alone, as if each document stood inside much clean
text, relative to what good text reaches by chance (``QUIET``), then the mean.  Each
good document is weighed by a target model without itself.
Documents are then sampled without replacement in proportion to
``exp(SHARPNESS * weight)``: Gumbel noise, a hash of ``doc_id``, is added to each
scaled log weight and the top k stay.  k is the number of documents whose weight
is not below the cut of -1.  At this SHARPNESS the selection is a threshold but for the
documents whose weight is within a few hundredths of a unit of the cut.

Bounds: at most ``LABEL_ROWS`` labelled documents (those of least id hash) fit the
target model and the cut; the raw model, weights and selection cover all rows.
Both models have a fixed number of buckets, so what the driver collects and
broadcasts (16 MB of counts, 4 MB of weights, 24 numbers a labelled document) does
not grow with the input.

Defined results
---------------
* null, empty and very short texts have no n-grams: weight 0, neutral;
* labels with a null are left out; a document with several labels is good only if
  all of them say so; without any good label all weights are 0 and all rows stay;
* rows with one ``doc_id`` share their noise; equal keys at the boundary stay
  together; an empty table gives an empty result; further columns are kept by
  ``keep_good`` and ignored elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, share, shared, slices, staged

#: Lengths of the byte n-grams, and hash buckets of each length (as a power of 2).
ORDERS = ((6, 20),)
#: Most labelled documents that fit the target model and the cut.
LABEL_ROWS = 20_000
#: To choose from: the count added to either model's expectation of a bucket, and the
#: log ratio of target to raw text down to which an n-gram is neutral.
SHAPES = ((3.0, 0.25), (10.0, 0.25), (10.0, 0.5), (30.0, 0.5))
#: N-grams of a window.
WINDOWS = (32, 128, 512, 2048, 8192)
#: To choose from: the share of good documents that lie beyond a unit of the windows, before the cut.
QUIET = (0.001, 0.005, 0.02)
#: Least unit of the mean, and of a window's sum.
LEAST_UNIT = np.array([1e-3] + [1.0] * len(WINDOWS))
#: Units of Gumbel noise in one unit of the weight.
SHARPNESS = 50.0

_SLICE = 4 << 20
_CHUNK = 1 << 14
#: Places of the orders' buckets in the models.
_PARTS = [slice(sum(1 << b for _, b in ORDERS[:k]), sum(1 << b for _, b in ORDERS[:k + 1]))
          for k in range(len(ORDERS))]
_SIZE = _PARTS[-1].stop
#: Bytes that count as a space.
_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[[9, 10, 11, 12, 13]] = 32


def _ngrams(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each order: bucket of every byte position of the slice, and each row's
    first and one-past-last position whose n-gram lies within the row's text."""
    text = batch.column("text").cast(pa.large_binary())
    ends = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
    first = int(ends[0])
    data = np.frombuffer(text.buffers()[2] or b"", np.uint8)[first:int(ends[-1])]
    folded, ends = _FOLD[data], ends - first
    for part, (n, bits) in zip(_PARTS, ORDERS):
        size = max(0, len(folded) - n + 1)
        h = np.zeros(size, np.uint32)
        for i in range(n):
            h *= np.uint32(0x9E3779B1)
            h += folded[i:i + size]
            h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA6B)
        buckets = (h >> np.uint32(32 - bits)).astype(np.int64) + part.start
        yield buckets, ends[:-1], np.maximum(ends[1:] - n + 1, ends[:-1])


def _evidence(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """By (statistic, row): the mean of a row's values, and its least sum over windows of each length."""
    begin, end = np.minimum(begin, len(values)), np.minimum(end, len(values))
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    n = end - begin
    out = np.zeros((1 + len(WINDOWS), len(n)))
    out[0] = (total[end] - total[begin]) / np.maximum(n, 1)
    some = np.flatnonzero(n)
    if len(some):
        starts = np.cumsum(n) - n
        at = np.arange(n.sum()) + np.repeat(begin - starts, n)
        stop = np.repeat(end, n)
        for k, width in enumerate(WINDOWS, 1):  # a window cut short at the end holds less evidence than a full one
            out[k, some] = np.minimum.reduceat(total[np.minimum(at + width, stop)] - total[at], starts[some])
    return out


def _log_ratio(target: np.ndarray, expected: np.ndarray, shape: tuple[float, float]) -> np.ndarray:
    smoothing, tolerance = shape
    return np.minimum(np.log((target + smoothing) / (expected + smoothing)) + tolerance, 0)


def _weights(evidence: np.ndarray, unit: np.ndarray) -> np.ndarray:
    return np.round((evidence / unit[:, None]).min(axis=0), 6)


def _count(batches):
    """Counts of one task: rows (chunk of buckets, raw counts, target counts)."""
    raw, target = np.zeros(_SIZE, np.int64), np.zeros(_SIZE, np.int64)
    for batch in slices(batches, limit=_SLICE):
        good = np.array(batch.column("good").to_pylist(), dtype=bool)
        for buckets, begin, end in _ngrams(batch):
            # +1 / -1 at the ends of each row's span marks the positions that count
            for counts, rows in ((raw, slice(None)), (target, good)):
                edge = np.zeros(len(buckets) + 1, np.int32)
                np.add.at(edge, np.minimum(begin[rows], len(buckets)), 1)
                np.add.at(edge, np.minimum(end[rows], len(buckets)), -1)
                counts += np.bincount(buckets[np.cumsum(edge[:-1]) > 0], minlength=_SIZE)
    chunks = range(0, _SIZE, _CHUNK)
    yield pa.record_batch([pa.array([c // _CHUNK for c in chunks], pa.int32()),
                           pa.array([raw[c:c + _CHUNK].tobytes() for c in chunks], pa.binary()),
                           pa.array([target[c:c + _CHUNK].tobytes() for c in chunks], pa.binary())],
                          names=["chunk", "raw", "target"])


def _add_up(batches):
    """Sum the counts of the chunks that this task holds, a row at a time."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, *counts in zip(*(c.to_pylist() for c in batch.columns)):
            both = np.stack([np.frombuffer(c, np.int64) for c in counts])
            sums[chunk] = sums[chunk] + both if chunk in sums else both
    yield pa.record_batch([pa.array(sums, pa.int32()),
                           pa.array([v[0].tobytes() for v in sums.values()], pa.binary()),
                           pa.array([v[1].tobytes() for v in sums.values()], pa.binary())],
                          names=["chunk", "raw", "target"])


_COUNTS = "chunk int, raw binary, target binary"


def _labelled(labels: DataFrame) -> DataFrame:
    """At most LABEL_ROWS of (label_id, good), those of least id hash."""
    return (labels.filter("doc_id is not null and quality is not null and toxic is not null")
            .groupBy(F.col("doc_id").alias("label_id"))
            .agg(F.min((F.col("quality") > 0) & (F.col("toxic") <= 0)).alias("good"))
            .orderBy(F.xxhash64("label_id"), "label_id").limit(LABEL_ROWS))


@dataclass(frozen=True)
class Model:
    """Evidence of each bucket and unit of each statistic; ``key`` and the boundary make the selection."""

    log_ratio: np.ndarray
    unit: np.ndarray
    boundary: float = float("-inf")

    def weights(self, batch: pa.RecordBatch) -> np.ndarray:
        return _weights(sum(_evidence(self.log_ratio[buckets], begin, end)
                            for buckets, begin, end in _ngrams(batch)), self.unit)

    def keys(self, weights: np.ndarray, doc_ids: pa.Array) -> np.ndarray:
        """Scaled log weight plus Gumbel noise, the noise a hash of the id."""
        ids = np.array([-1 if i is None else i for i in doc_ids.to_pylist()], np.int64).astype(np.uint64)
        z = (ids + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        u = ((z ^ (z >> np.uint64(31))) >> np.uint64(12)).astype(np.float64)
        return np.round(SHARPNESS * weights - np.log(-np.log((u + 0.5) / 2**52)), 6)


def _score(model):
    def run(batches):
        fitted = shared(model)
        for batch in slices(batches, limit=_SLICE):
            weights = fitted.weights(batch)
            keys = fitted.keys(weights, batch.column("doc_id"))
            yield pa.record_batch([batch.column("doc_id"), pa.array(weights), pa.array(keys)],
                                  names=["doc_id", "log_weight", "sample_key"])
    return run


def _held_out(counts):
    """Evidence of labelled rows under each of SHAPES, of good ones without their own counts in the target."""
    def run(batches):
        raw, target = counts.value
        whole = [(raw[at].sum(), target[at].sum()) for at in _PARTS]
        for batch in slices(batches, limit=_SLICE):
            good = batch.column("good").to_pylist()
            out = np.zeros((len(good), len(SHAPES), 1 + len(WINDOWS)))
            for (all_raw, all_target), (buckets, begin, end) in zip(whole, _ngrams(batch)):
                for i, (a, b) in enumerate(zip(begin, end)):
                    found, place, own = np.unique(buckets[a:b], return_inverse=True, return_counts=True)
                    rest = target[found] - own * good[i]
                    expected = raw[found] * (max(all_target - len(place) * good[i], 0) / max(all_raw, 1))
                    for k, shape in enumerate(SHAPES):
                        values = _log_ratio(rest, expected, shape)[place]
                        out[i, k] += _evidence(values, np.array([0]), np.array([len(values)]))[:, 0]
            yield pa.record_batch([batch.column("label_id"), batch.column("good"),
                                   pa.array(list(out.reshape(len(good), -1)), pa.list_(pa.float64()))],
                                  names=["label_id", "good", "evidence"])
    return run


def _choose(evidence: np.ndarray, good: np.ndarray) -> tuple[tuple[float, float], np.ndarray, float]:
    """Shape, units and cut with least errors on labelled rows; evidence by (shape, statistic, row).
    The windows are fitted alone, as a row's mean tells nothing inside much clean text; then the
    mean is fitted on the rows that the windows accept."""
    if good.all():
        return SHAPES[0], LEAST_UNIT, float("-inf")
    fits = []
    for shape, found in zip(SHAPES, evidence):
        for quiet in QUIET:
            unit = LEAST_UNIT.copy()
            if good.any():
                unit[1:] = np.maximum(unit[1:], -np.quantile(found[1:, good], quiet, axis=1))
            cut = _best_cut(_weights(found[1:], unit[1:]), good)
            if np.isfinite(cut) and cut < 0:
                unit[1:] *= -cut
            passed = _weights(found[1:], unit[1:]) >= -1
            cut = _best_cut(found[0, passed], good[passed])
            unit[0] = np.inf if cut == float("-inf") else max(-cut, unit[0])
            errors = (passed != good).sum() + ((_weights(found, unit) >= -1) != good).sum()
            fits.append((int(errors), shape, unit))
    return *min(fits, key=lambda f: f[0])[1:], -1.0


def _best_cut(weights: np.ndarray, good: np.ndarray) -> float:
    """The weight from which on to accept, with least errors on the labelled rows."""
    if not len(weights) or good.all():
        return float("-inf")
    order = np.argsort(weights, kind="stable")
    weights, good = weights[order], good[order]
    starts = np.concatenate([[0], np.flatnonzero(np.diff(weights)) + 1, [len(weights)]])
    lost = np.concatenate([[0], np.cumsum(good)])[starts]
    passed = (~good).sum() - np.concatenate([[0], np.cumsum(~good)])[starts]
    best = starts[int(np.argmin(lost + passed))]
    return float(weights[best]) if best < len(weights) else float("inf")


def _kth_key(scores: DataFrame, k: int, bins: int = 4096, few: int = 10_000) -> float:
    """The k-th largest ``sample_key``: histograms narrow the range until few keys are left."""
    if k <= 0:
        return float("inf")
    low, high = scores.agg(F.min("sample_key"), F.max("sample_key")).first()
    left = k
    while True:
        inside = scores.filter(F.col("sample_key").between(low, high))
        width = (high - low) / bins
        if width <= 1e-7:
            return low
        bin_of = F.least(F.floor((F.col("sample_key") - low) / width), F.lit(bins - 1))
        counts = sorted(inside.groupBy(bin_of.alias("bin"))
                        .agg(F.count(F.lit(1)).alias("n"), F.min("sample_key").alias("low"),
                             F.max("sample_key").alias("high")).collect(), reverse=True)
        for row in counts:
            if left <= row.n:
                break
            left -= row.n
        else:
            return low
        low, high = row.low, row.high
        if row.n <= few:
            keys = [r[0] for r in scores.filter(F.col("sample_key").between(low, high))
                    .select("sample_key").collect()]
            return sorted(keys, reverse=True)[left - 1]


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def fit(docs: DataFrame, labels: DataFrame) -> tuple[Model, DataFrame]:
    """The fitted model, and (doc_id, log_weight, sample_key) of every row."""
    spark = docs.sparkSession
    sample = staged(_labelled(labels), "label-sample")
    marked = (_texts(docs).join(F.broadcast(sample), F.col("doc_id") == F.col("label_id"), "left")
              .select("text", F.coalesce("good", F.lit(False)).alias("good")))
    rows = arrow_map(arrow_map(marked, _count, _COUNTS).repartition(_SIZE // _CHUNK, "chunk"), _add_up, _COUNTS).collect()
    raw, target = np.zeros(_SIZE), np.zeros(_SIZE)
    for r in rows:
        at = slice(r.chunk * _CHUNK, (r.chunk + 1) * _CHUNK)
        raw[at], target[at] = np.frombuffer(r.raw, np.int64), np.frombuffer(r.target, np.int64)
    known = (_texts(docs).join(F.broadcast(sample), F.col("doc_id") == F.col("label_id"))
             .select("label_id", "good", "text"))
    known = arrow_map(known, _held_out(spark.sparkContext.broadcast((raw, target))),
                      "label_id long, good boolean, evidence array<double>").collect()
    good = np.array([r.good for r in known], dtype=bool)
    evidence = np.array([r.evidence for r in known]).reshape(len(known), len(SHAPES), 1 + len(WINDOWS))
    shape, unit, cut = _choose(evidence.transpose(1, 2, 0), good)
    ratio = np.zeros(_SIZE, np.float32)
    for at in _PARTS:
        if target[at].sum():
            ratio[at] = _log_ratio(target[at], raw[at] * (target[at].sum() / raw[at].sum()), shape)
    model = Model(ratio, unit)
    scores = staged(arrow_map(_texts(docs), _score(share(spark, model)),
                              "doc_id long, log_weight double, sample_key double"), "quality-scores")
    if not target.any() or cut == float("-inf"):
        return model, scores
    k = scores.filter(F.col("log_weight") >= F.lit(cut)).count()
    return Model(ratio, unit, _kth_key(scores, k)), scores


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, log_weight, sample_key, accepted."""
    model, scores = fit(docs, labels)
    return scores.withColumn("accepted", F.col("sample_key") >= F.lit(model.boundary))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows that the classifier rejects; all columns stay, no shuffle."""
    model = share(docs.sparkSession, fit(docs, labels)[0])

    def accepted(batches):
        fitted = shared(model)
        for batch in slices(batches, limit=_SLICE):
            text = batch.column("text").fill_null("")
            plain = pa.record_batch([text], names=["text"])
            keys = fitted.keys(fitted.weights(plain), batch.column("doc_id"))
            yield batch.filter(pa.array(keys >= fitted.boundary))

    return arrow_map(docs, accepted, docs.schema)
