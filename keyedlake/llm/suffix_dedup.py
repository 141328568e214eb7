"""Removal of repeated substrings by bucket-pointer refinement of suffixes.

A byte goes if a ``LENGTH``-byte string that covers it also starts in a document
with a smaller ``doc_id``.  That is a question about suffixes up to depth LENGTH:
which of them share their first LENGTH bytes, and what is the least document of each
such bucket.  Five steps, of which only the second and fourth compare documents:

1. *Initial q-gram buckets.*  Every suffix (a window of LENGTH bytes) is keyed by the
   least hash of the q-grams that start within it and fit; equal windows have
   equal keys.  Consecutive windows with one key form a *run*, about thirteen windows
   long, so that runs rather than suffixes are announced to the key's bucket.
2. *Singletons leave.*  Runs whose key occurs in one document only need no further
   refinement.
3. The runs that are left are cut out of their texts and sent to the key's bucket.
4. *Refinement.*  Within a bucket the suffixes start in buckets of Q-grams, which are refined by
   sorting on the bucket identifiers of later offsets (at Q = 26 one round makes depth LENGTH; a
   smaller Q takes more, each on the buckets that the round before left).  Suffixes that have
   become single leave before each round.  Identifiers are hashes, so none is made for an
   offset that no live suffix looks at; the last buckets are held against their bytes.
5. The removed runs of windows are put together per document and cut out of its text.

Keys only bring candidates together; what is removed is decided on the bytes.

Skew: a task announces a key for two documents at most, and sends a run of given bytes
for the least document only; what it knows of the others it tells by itself.  So a
string that a third of all documents hold costs its bucket a few rows a task.  The runs at the
two ends of such a string hold each document's own context, so they are all different
under one key: a key with many different runs is *hot* (counted with the announcements), and its
runs are sent window by window, dealt by the windows' own bytes.  Hot keys are few by their
definition (at most about 8 * MOST_HOT of 8 bytes) and broadcast.  Documents are dealt by a hash of
the id.  The number of buckets follows the bytes of the input.

Defined results
---------------
* null text is the empty text; texts of fewer than LENGTH bytes lose nothing;
* rows that repeat a ``doc_id`` are one document: they take nothing from each other;
  a null ``doc_id`` is no smaller or larger than any other, so such rows stay whole
  and take nothing; repeated rows have equal results;
* an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, sha256_hex, slices, staged, text_bytes

LENGTH = 50
Q = 26
#: Bytes of text whose keys share a bucket, when announced and when sent with their bytes.
BUCKET_BYTES, REFINED_BYTES = 32 << 20, 8 << 20
#: A longer text is worked on in segments of so many bytes.
SEGMENT = 2 << 20
#: Different runs that a key has at least to be hot; or, if that is more, the share of all bytes that leaves
#: MOST_HOT keys (8 bytes each), which are broadcast.
HOT_RUNS, MOST_HOT = 4096, 100_000

_WINDOW = LENGTH - Q + 1
_P = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of P and of its inverse modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        del _POWERS[:]
        for base in (_P, pow(_P, -1, 2**64)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS.append(np.cumprod(steps))
    return _POWERS[0][:n], _POWERS[1][:n]


def _sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while 2 * span <= width:
        h = np.minimum(h[:-span], h[span:])
        span *= 2
    rest = width - span
    return np.minimum(h[:len(h) - rest], h[rest:]) if rest else h


def _pieces(texts: list[bytes]) -> Iterator[list[tuple[int, int, bytes]]]:
    """(row, offset, bytes) in lists of bounded size; segments overlap by LENGTH - 1."""
    group, size = [], 0
    for row, text in enumerate(texts):
        for at in range(0, max(len(text) - LENGTH + 1, 0), SEGMENT):
            piece = text[at:at + SEGMENT + LENGTH - 1]
            if group and size + len(piece) > SEGMENT:
                yield group
                group, size = [], 0
            group.append((row, at, piece))
            size += len(piece)
    if group:
        yield group


class Runs:
    """Runs of windows with one key: row, start in the text, windows, key; and their bytes."""

    def __init__(self, pieces: list[tuple[int, int, bytes]]):
        self.data = b"".join(p for _, _, p in pieces)
        buffer = np.frombuffer(self.data, np.uint8)
        sizes = np.array([len(p) for _, _, p in pieces], np.int64)
        begin = np.cumsum(sizes) - sizes
        powers, inverse = _powers(len(buffer))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(buffer * powers + powers, dtype=np.uint64)])
        h = (total[Q:] - total[:-Q]) * inverse[:len(buffer) - Q + 1]
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        key = _sliding_min(h ^ (h >> np.uint64(29)), _WINDOW)
        # windows that lie within one piece; runs break where the key does or a piece begins
        windows = sizes - LENGTH + 1
        valid = np.zeros(len(key) + 1, np.int8)
        valid[begin] += 1
        np.subtract.at(valid, np.minimum(begin + windows, len(key)), 1)
        inside = np.cumsum(valid[:-1]) > 0
        breaks = np.ones(len(key), bool)
        breaks[1:] = key[1:] != key[:-1]
        breaks[begin[begin < len(key)]] = True
        starts = np.flatnonzero(breaks & inside)
        stop = np.flatnonzero(breaks | ~inside)
        nxt = np.append(stop, len(key))[np.searchsorted(stop, starts, side="right")]
        piece = np.searchsorted(begin, starts, side="right") - 1
        self.at, self.windows, self.key = starts, nxt - starts, key[starts]
        #: of a run's whole bytes; equal for equal runs
        self.print = (total[nxt + LENGTH - 1] - total[starts]) * inverse[starts] if len(starts) else key[:0]
        self.row = np.array([r for r, _, _ in pieces], np.int64)[piece]
        self.start = starts - begin[piece] + np.array([o for _, o, _ in pieces], np.int64)[piece]

    def content(self, i: int) -> bytes:
        a = self.at[i]
        return self.data[a:a + self.windows[i] + LENGTH - 1]


def _compressed(data: bytes) -> bytes:
    import zstandard

    return zstandard.compress(data, 1) if data else b""


def _plain(data: bytes) -> bytes:
    import zstandard

    return zstandard.decompress(data) if data else b""


def _packed(values: np.ndarray) -> bytes:
    """32-bit integers by byte planes (the upper ones are mostly zero), compressed."""
    return _compressed(np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(_plain(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def _split(groups: np.ndarray, order: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(group, members) over ``order``, which sorts ``groups``."""
    if len(order):
        cuts = np.flatnonzero(np.diff(groups[order])) + 1
        for part in np.split(order, cuts):
            yield int(groups[part[0]]), part


#: Rows between steps: a bucket (of keys if not negative, else of documents that need no
#: comparison), and per document its id, its text's key, its number of runs (``owner``)
#: and per run packed numbers.
_ANNOUNCED = "bucket int, docs binary, owner binary, mark binary, start binary, windows binary, content binary"
_NAMES = ["bucket", "docs", "owner", "mark", "start", "windows", "content"]
_TYPES = [pa.int32()] + [pa.binary()] * 6
#: What is found out, for all documents of one destination in one row, and then per document.
_TOLD = "dest int, docs binary, owner binary, begin binary, end binary"
_DOCUMENT = "doc_id long, text_key long, begin binary, end binary"


def _spread(ids: np.ndarray, n: int) -> np.ndarray:
    """Documents dealt to ``n`` destinations by a hash of the id."""
    h = ids.astype(np.int64).view(np.uint64) * np.uint64(_P)
    return ((h ^ (h >> np.uint64(32))) % np.uint64(n)).astype(np.int64)


def _message(bucket: int, docs: np.ndarray, rows: np.ndarray, mark=None, start=None, windows=None, content=b""):
    """One row of _ANNOUNCED about runs of documents ``rows`` (in order); docs: (id, text key) by row."""
    used, owner = np.unique(rows, return_counts=True)
    none = np.zeros(0, np.int64)
    return (bucket, _compressed(docs[used].T.tobytes()), _packed(owner), (none if mark is None else mark).astype("<u4").tobytes(),
            _packed(none if start is None else start), _packed(none if windows is None else windows), _compressed(content))


def _as_batch(messages: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*messages)) or [[]] * len(_NAMES)
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, _TYPES)], names=_NAMES)


def _docs_of(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column("doc_id").to_numpy(), batch.column("text_key").to_numpy()], axis=1)


def _texts_of(batch: pa.RecordBatch) -> list[bytes]:
    return batch.column("text").cast(pa.binary()).to_pylist()


def _first_documents(groups: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Which members belong to the ``most`` least ids of their group."""
    order = np.lexsort((ids, groups))
    g, d = groups[order], ids[order]
    new_group = np.concatenate([[True], g[1:] != g[:-1]])[:len(g)]
    new_id = new_group | np.concatenate([[True], d[1:] != d[:-1]])[:len(g)]
    nth = np.cumsum(new_id)
    nth = nth - np.maximum.accumulate(np.where(new_group, nth, 0))
    first = np.empty(len(g), bool)
    first[order] = nth < most
    return first


def _announce(buckets: int):
    def run(batches):
        for batch in slices(batches, limit=SEGMENT):
            docs, out = _docs_of(batch), []
            for pieces in _pieces(_texts_of(batch)):
                runs = Runs(pieces)
                _, group = np.unique(runs.key, return_inverse=True)
                asks = _first_documents(group, docs[runs.row, 0], 2)
                # how many different runs the key has here beyond one, told with one of its runs
                several = np.bincount(group[np.unique(runs.print, return_index=True)[1]], minlength=1)
                extra, chosen = np.zeros(len(group), np.int64), np.flatnonzero(asks)
                told = chosen[np.unique(group[chosen], return_index=True)[1]]
                extra[told] = several[group[told]] - 1
                bucket = (runs.key >> np.uint64(32)) % np.uint64(buckets)
                mark = runs.key & np.uint64(0xFFFFFFFF)
                order = chosen[np.argsort(bucket[chosen], kind="stable")]
                for b, part in _split(bucket, order):
                    out.append(_message(b, docs, runs.row[part], mark[part], runs.start[part], extra[part]))
                known = np.flatnonzero(~asks)
                spread = _spread(docs[runs.row, 0], buckets)
                for k, part in _split(spread, known[np.argsort(spread[known], kind="stable")]):
                    out.append(_message(-1 - k, docs, runs.row[part], None, runs.start[part]))
            if out:
                yield _as_batch(out)
    return run


def _gathered(rows: pd.DataFrame):
    """All messages of a bucket as one: docs, and per run its document and numbers."""
    docs = [np.frombuffer(_plain(d), np.int64).reshape(2, -1).T for d in rows["docs"]]
    base = np.cumsum([0] + [len(d) for d in docs])
    owner = [np.repeat(np.arange(b, b + len(d)), _unpacked(o)) for o, b, d in zip(rows["owner"], base, docs)]
    join = lambda parts: np.concatenate(parts) if len(parts) else np.zeros(0, np.int64)
    return (np.concatenate(docs), join(owner),
            join([np.frombuffer(m, "<u4") for m in rows["mark"]]), join([_unpacked(s) for s in rows["start"]]),
            join([_unpacked(w) for w in rows["windows"]]))


def _told(dests: int, docs: np.ndarray, owner: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pd.DataFrame:
    """Rows of _TOLD, one a destination: documents are dealt by id."""
    dest = _spread(docs[owner, 0], dests)
    rows = []
    for d, part in _split(dest, np.lexsort((owner, dest))):
        used, count = np.unique(owner[part], return_counts=True)
        rows.append((d, _compressed(docs[used].T.tobytes()), _packed(count), _packed(begin[part]), _packed(end[part])))
    return pd.DataFrame(rows, columns=["dest", "docs", "owner", "begin", "end"])


def _per_document(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """All that was told of each document of a destination, as 32-bit integers."""
    docs = [np.frombuffer(_plain(d), np.int64).reshape(2, -1).T for d in rows["docs"]]
    owner = np.concatenate([np.repeat(d, _unpacked(o), axis=0) for d, o in zip(docs, rows["owner"])])
    begin = np.concatenate([_unpacked(x) for x in rows["begin"]]).astype("<u4")
    end = np.concatenate([_unpacked(x) for x in rows["end"]]).astype("<u4")
    ids, group = np.unique(owner, axis=0, return_inverse=True)
    group = group.ravel()
    out = [(int(ids[g, 0]), int(ids[g, 1]), begin[part].tobytes(), end[part].tobytes())
           for g, part in _split(group, np.argsort(group, kind="stable"))]
    return pd.DataFrame(out, columns=["doc_id", "text_key", "begin", "end"])


def _shared(dests: int, hot_runs: int):
    """Runs whose key occurs in several documents of the bucket; and, for destination -1, its hot keys."""
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        docs, owner, mark, start, extra = _gathered(rows)
        if key[0] < 0 or not len(owner):
            return _told(dests, docs, owner, start, start)
        marks, group = np.unique(mark, return_inverse=True)
        hot = marks[np.bincount(group, extra) >= hot_runs].astype(np.int64) | (np.int64(key[0]) << 32)
        ids = docs[owner, 0]
        least = np.full(group.max() + 1, np.iinfo(np.int64).max)
        most = np.full(group.max() + 1, np.iinfo(np.int64).min)
        np.minimum.at(least, group, ids)
        np.maximum.at(most, group, ids)
        chosen = np.flatnonzero((least < most)[group])
        told = _told(dests, docs, owner[chosen], start[chosen], start[chosen])
        if len(hot):
            told.loc[len(told)] = (-1, hot.astype("<i8").tobytes(), b"", b"", b"")
        return told
    return run


def _windows(runs: Runs, of: np.ndarray, start: np.ndarray):
    """The windows of runs ``of`` as (run, start in the text, bytes)."""
    which = np.repeat(of, runs.windows[of])
    nth = np.arange(len(which)) - np.repeat(np.cumsum(runs.windows[of]) - runs.windows[of], runs.windows[of])
    at = runs.at[which] + nth
    return which, start[which] + nth, [runs.data[a:a + LENGTH] for a in at.tolist()]


def _send(key_buckets: int, buckets: int, hot_keys):
    """Cut out the runs that are left; of equal bytes the least document's are sent.

    Runs of a hot key, which may be as many as documents, are sent window by window, dealt by
    the windows' own bytes: only equal windows need to meet.
    """
    def run(batches):
        for batch in slices(batches, limit=SEGMENT):
            docs, out = _docs_of(batch), []
            wanted = [np.frombuffer(told, "<u4").astype(np.int64) for told in batch.column("begin").to_pylist()]
            for pieces in _pieces(_texts_of(batch)):
                runs = Runs(pieces)
                # (row, start) as one number, starts being below 2**32
                place = (runs.row << np.int64(32)) | runs.start
                here = np.concatenate([(np.int64(r) << np.int64(32)) | wanted[r] for r in {p[0] for p in pieces}])
                left = np.flatnonzero(np.isin(place, here))
                named = ((runs.key[left] >> np.uint64(32)) % np.uint64(key_buckets) << np.uint64(32)
                         | runs.key[left] & np.uint64(0xFFFFFFFF)).astype(np.int64)
                is_hot = np.isin(named, hot_keys.value)
                hot, left = left[is_hot], left[~is_hot]
                which, begin, bytes_of = _windows(runs, hot, runs.start)
                row = np.concatenate([runs.row[left], runs.row[which]])
                start = np.concatenate([runs.start[left], begin])
                windows = np.concatenate([runs.windows[left], np.ones(len(which), np.int64)])
                content = [runs.content(i) for i in left] + bytes_of
                classes: dict[bytes, int] = {}
                group = np.array([classes.setdefault(c, len(classes)) for c in content], np.int64)
                sent = _first_documents(group, docs[row, 0], 1)
                dealt = np.concatenate([runs.key[left] >> np.uint64(8), np.array(
                    [zlib.crc32(c) for c in bytes_of], np.uint64)]) % np.uint64(buckets)
                chosen = np.flatnonzero(sent)
                # messages tell runs in the order of their documents
                for b, part in _split(dealt, chosen[np.lexsort((row[chosen], dealt[chosen]))]):
                    out.append(_message(b, docs, row[part], None, start[part], windows[part],
                                        b"".join(content[i] for i in part)))
                known = np.flatnonzero(~sent)
                spread = _spread(docs[row, 0], buckets)
                for k, part in _split(spread, known[np.lexsort((row[known], spread[known]))]):
                    out.append(_message(-1 - k, docs, row[part], None, start[part], windows[part]))
            if out:
                yield _as_batch(out)
    return run


def _identifiers(data: bytes, offsets: np.ndarray) -> np.ndarray:
    """Identifiers of the q-gram buckets at ``offsets``: 64-bit hashes, so no rank has to be made."""
    buffer = np.frombuffer(data, np.uint8)
    out = np.empty(len(offsets), np.uint64)
    step = 1 << 16  # powers of a bounded range, whatever the data's length
    order = np.argsort(offsets, kind="stable") if np.any(offsets[1:] < offsets[:-1]) else np.arange(len(offsets))
    for part in np.split(order, np.searchsorted(offsets[order], np.arange(step, len(data), step))):
        if not len(part):
            continue
        low = int(offsets[part[0]]) // step * step
        piece = buffer[low:low + step + Q]
        powers, inverse = _powers(len(piece))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(piece * powers + powers, dtype=np.uint64)])
        at = offsets[part] - low
        out[part] = (total[at + Q] - total[at]) * inverse[at]
    return out


def _sorted_into(identifiers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(members that share their identifier, their buckets): sorting puts equal ones side by side."""
    order = np.argsort(identifiers)
    ranked = identifiers[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]])[:len(ranked)]
    bucket = np.cumsum(new) - 1
    shared = np.bincount(bucket, minlength=1)[bucket] > 1 if len(bucket) else new
    return order[shared], bucket[shared]


def refine(data: bytes, offsets: np.ndarray) -> np.ndarray:
    """Buckets of the suffixes at ``offsets`` by their first LENGTH bytes (-1: a single one).

    The initial buckets are q-grams.  They are refined by sorting on (bucket, identifier of the bucket at a later
    offset); single suffixes leave and each round works with the buckets as the rounds before left
    them, until the depth is LENGTH.  Identifiers are hashes: at the end, each member is held against
    its bucket's first on the bytes, and a bucket that a collision has made is parted by its bytes.
    """
    out = np.full(len(offsets), -1, np.int64)
    alive, bucket = _sorted_into(_identifiers(data, offsets))
    depth = Q
    while depth < LENGTH and len(alive):
        step = min(depth, LENGTH - depth, Q)
        later = _identifiers(data, offsets[alive] + depth + step - Q)
        pair = (later ^ (later >> np.uint64(32))) * np.uint64(_P) + bucket.astype(np.uint64)
        kept, bucket = _sorted_into(pair)
        alive = alive[kept]
        depth += step
    if not len(alive):
        return out
    window = np.lib.stride_tricks.sliding_window_view(np.frombuffer(data, np.uint8), LENGTH)
    first = np.concatenate([[True], bucket[1:] != bucket[:-1]])
    leader = alive[np.flatnonzero(first)[np.cumsum(first) - 1]]
    out[alive] = bucket
    for i in range(0, len(alive), 1 << 18):
        a, b = alive[i:i + (1 << 18)], leader[i:i + (1 << 18)]
        for wrong in a[(window[offsets[a]] != window[offsets[b]]).any(1)].tolist():
            out[wrong] = -2 - int(out[wrong])  # not its bucket's bytes
    if (out < -1).any():
        names: dict[tuple[int, bytes], int] = {}
        top = int(out.max()) + 1
        for i in np.flatnonzero(out < -1).tolist():
            out[i] = top + names.setdefault((int(out[i]), data[offsets[i]:offsets[i] + LENGTH]), len(names))
    return out


def _removed(dests: int):
    """Byte spans of a bucket's runs that also start in a smaller document."""
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        docs, owner, _, start, windows = _gathered(rows)
        if key[0] < 0 or not len(owner):
            return _told(dests, docs, owner, start, start + windows + LENGTH - 1)
        data = b"".join(map(_plain, rows["content"]))
        sizes = windows + LENGTH - 1
        ends = np.cumsum(sizes)
        classes: dict[bytes, int] = {}
        kind = np.array([classes.setdefault(data[a:b], len(classes)) for a, b in zip(ends - sizes, ends)], np.int64)
        ids = docs[owner, 0]
        least = np.full(len(classes), np.iinfo(np.int64).max)
        np.minimum.at(least, kind, ids)
        # windows of the distinct runs, then of all runs
        count = np.array([len(c) - LENGTH + 1 for c in classes], np.int64)
        first = np.cumsum(count) - count
        place = np.arange(count.sum()) + np.repeat(np.arange(len(count)) * (LENGTH - 1), count)
        bucket = refine(b"".join(classes), place)
        window_least = np.repeat(least, count)
        shared = bucket >= 0
        if shared.any():
            best = np.full(bucket.max() + 1, np.iinfo(np.int64).max)
            np.minimum.at(best, bucket[shared], window_least[shared])
            window_least[shared] = best[bucket[shared]]
        of = np.repeat(np.arange(len(owner)), windows)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
        gone = window_least[first[kind[of]] + nth] < ids[of]
        # spans of consecutive windows that go, within each run
        edge = np.concatenate([[True], of[1:] != of[:-1]])
        begins = np.flatnonzero(gone & (edge | ~np.concatenate([[False], gone[:-1]])))
        last = np.flatnonzero(gone & np.concatenate([edge[1:] | ~gone[1:], [True]]))
        return _told(dests, docs, owner[of[begins]], start[of[begins]] + nth[begins],
                     start[of[begins]] + nth[last] + LENGTH)
    return run


def _cut(batches):
    """Digests of each row and, in ``kept``, what is left of its text."""
    for batch in slices(batches, limit=SEGMENT):
        out = []
        for text, begin, end in zip(_texts_of(batch), *(batch.column(c).to_pylist() for c in ("begin", "end"))):
            spans = sorted(zip(*(np.frombuffer(x or b"", "<u4").tolist() for x in (begin, end))))
            merged: list[list[int]] = []
            for a, b in spans:
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], b)
                else:
                    merged.append([a, b])
            edges = [0, *(x for span in merged for x in span), len(text)]
            kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
            out.append((len(text), sum(b - a for a, b in merged), len(merged), sha256_hex(kept), kept))
        columns = list(zip(*out))
        types = [pa.int64()] * 3 + [pa.string(), pa.binary()]
        yield pa.record_batch([batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, types))],
                              names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (binary)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.withColumn("text_key", F.xxhash64("text"))
    total = text_bytes(texts)
    buckets, refined = max(8, -(-total // BUCKET_BYTES)), max(8, -(-total // REFINED_BYTES))
    known = texts.filter(F.col("doc_id").isNotNull() & (F.octet_length("text") >= LENGTH))
    document = ["doc_id", "text_key"]

    def by_document(told: DataFrame) -> DataFrame:
        return told.groupBy("dest").applyInPandas(_per_document, _DOCUMENT)

    told = staged(arrow_map(known, _announce(buckets), _ANNOUNCED).groupBy("bucket")
                  .applyInPandas(_shared(buckets, max(HOT_RUNS, total // MOST_HOT // 8)), _TOLD), "shared")
    hot = [np.frombuffer(r["docs"], "<i8") for r in told.filter("dest < 0").select("docs").collect()]
    hot_keys = docs.sparkSession.sparkContext.broadcast(np.sort(np.concatenate([np.zeros(0, np.int64), *hot])))
    shared = by_document(told.filter("dest >= 0"))
    removed = staged(by_document(arrow_map(known.join(shared.drop("end"), document), _send(buckets, refined, hot_keys), _ANNOUNCED)
                                 .groupBy("bucket").applyInPandas(_removed(buckets), _TOLD)), "repeats")
    return arrow_map(texts.join(removed, document, "left"), _cut,
                     "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
