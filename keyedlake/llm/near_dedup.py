"""Near-duplicate classes with SetSketch registers.

1. *Sketch.*  A document's set are the hashes of its distinct word shingles.  Register
   i holds ``floor(1 - log_b x)`` of the least exponential value x that hash function i
   gives to a member, cut to [0, Q + 1]: exponentially spaced, truncated minima.  The
   registers of a union are the larger ones, register by register.
2. *Classes.*  Documents with one set are one class, named by its least ``doc_id``.
3. *Candidates.*  ``BANDS`` bands of ``ROWS`` registers; classes that agree in a band
   share a bucket.  First each member is paired with the bucket's least class only.
4. *Estimate and verify.*  From the registers that are larger, smaller and equal, and the
   set sizes, the similarity is estimated by maximum likelihood; pairs ``MARGIN`` and
   more below the threshold leave.  The others are confirmed on the full sets.
5. *The rest.*  Components of the confirmed links are formed.  A bucket within one
   component has nothing left to find.  In the others the pairs across components are
   estimated and compared on shingle hashes in blocks (never written as pairs); pairs
   that link components are confirmed on the full sets and the components formed again.
   No link of two components that share a bucket is lost, whatever the bucket's size.

At the threshold of 0.8 a pair shares no bucket with probability (1 - 0.8**4)**32, or
5e-8, and is estimated below the margin with about 1e-5.

Defined results
---------------
* null, empty and word-less texts have an empty set, are linked with nothing and stay;
* each row belongs to the class of its own text; classes that one ``doc_id`` names (rows
  that repeat an id with another text) count as one, compared by the text of least set
  key; a null ``doc_id`` has no component (null) and stays;
* an empty table gives an empty result; further columns are ignored by
  ``near_duplicates`` and kept by ``drop_near_copies``, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, slices, staged
from .components import connected_components

#: Registers of a sketch: bands for candidates, all of them for the estimate.
BANDS, ROWS = 32, 4
REGISTERS = BANDS * ROWS
#: Base and rate of the registers, and their largest value but one.
BASE, RATE, Q = 1.001, 20.0, 2**16 - 2
#: How far below the threshold an estimate may be for the pair to be confirmed.
MARGIN = 0.15
#: Most members of a bucket that one task compares with as many others.
BLOCK_MEMBERS = 2048
#: Members of small buckets that one task takes together, about.
GROUP_MEMBERS = 4096

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_RANDOM = np.random.default_rng(20240501)
_FACTOR = _RANDOM.integers(0, 2**63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSET = _RANDOM.integers(0, 2**63, REGISTERS, dtype=np.uint64)


def words_of(text: str | None) -> list[bytes]:
    """Words of the text with A-Z lower-cased; only space and 0x09 to 0x0D part words."""
    return text.encode("utf-8", "replace").translate(_FOLD).split() if text else []


def shingles(text: str | None, width: int) -> set[bytes]:
    """The full set, for confirming links."""
    words = words_of(text)
    if len(words) < width:
        return {b" ".join(words)} if words else set()
    return {b" ".join(words[i:i + width]) for i in range(len(words) - width + 1)}


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    from xxhash import xxh3_64_intdigest

    words = words_of(text)
    h = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(len(h) - width + 1, 1) if len(h) else 0
    joint = np.full(n, min(len(h), width), np.uint64)
    for i in range(min(width, len(h))):
        joint = _mixed(joint * np.uint64(0x9E3779B97F4A7C15) + h[i:i + n])
    return np.unique(joint)


def registers(hashes: np.ndarray) -> np.ndarray:
    """The SetSketch registers of a non-empty set of hashes."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), 2048):
        np.minimum(least, (hashes[i:i + 2048, None] * _FACTOR + _OFFSET).min(axis=0), out=least)
    x = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64) / RATE
    return np.clip(np.floor(1 - np.log(np.maximum(x, 1e-300)) / np.log(BASE)), 0, Q + 1).astype(np.uint16)


def _band_keys(regs: np.ndarray) -> np.ndarray:
    """A hash of each band's number and registers."""
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) + regs[k::ROWS].astype(np.uint64))
    return key.astype(np.int64)


def _chance(x: np.ndarray) -> np.ndarray:
    """Chance that one register is larger, given the share x of the joint rate."""
    return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)


def estimated_similarity(larger, smaller, size_a, size_b) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity from register comparisons and set sizes."""
    larger, smaller = np.asarray(larger, np.float64), np.asarray(smaller, np.float64)
    equal = REGISTERS - larger - smaller
    u = size_a / (size_a + size_b)
    v = 1 - u
    low, high = np.zeros_like(u), np.minimum(u / v, v / u)

    def likelihood(j):
        p, q = _chance(u - v * j), _chance(v - u * j)
        part = lambda n, x: n * np.log(np.maximum(x, 1e-12))
        return part(larger, p) + part(smaller, q) + part(equal, 1 - p - q)

    for _ in range(24):  # ternary search: the likelihood is concave
        a, b = low + (high - low) / 3, high - (high - low) / 3
        left = likelihood(a) > likelihood(b)
        low, high = np.where(left, low, a), np.where(left, b, high)
    return (low + high) / 2


def _passes(larger, smaller, size_a, size_b, threshold: int) -> np.ndarray:
    size_a, size_b = np.asarray(size_a, np.float64), np.asarray(size_b, np.float64)
    sizes = 100 * np.minimum(size_a, size_b) >= threshold * np.maximum(size_a, size_b)
    return sizes & (estimated_similarity(larger, smaller, size_a, size_b) >= threshold / 100 - MARGIN)


def _sketch(width: int):
    def run(batches):
        from xxhash import xxh3_128_digest

        for batch in slices(batches, limit=1 << 20):
            sizes, keys, sketches, bands = [], [], [], []
            for text in batch.column("text").to_pylist():
                hashes = shingle_hashes(text, width)
                sizes.append(len(hashes))
                keys.append(xxh3_128_digest(hashes.tobytes()) if len(hashes) else None)
                regs = registers(hashes) if len(hashes) else None
                sketches.append(None if regs is None else regs.tobytes())
                bands.append([] if regs is None else _band_keys(regs).tolist())
            yield pa.record_batch([batch.column("doc_id"), batch.column("text_key"), pa.array(sizes, pa.int64()),
                                   pa.array(keys, pa.binary()), pa.array(sketches, pa.binary()),
                                   pa.array(bands, pa.list_(pa.int64()))],
                                  names=["doc_id", "text_key", "n_shingles", "set_key", "registers", "bands"])
    return run


def _regs(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint16).reshape(-1, REGISTERS)


def _verify(width: int, threshold: int):
    """Estimate, then confirm on full sets: rows (a, b, linked)."""
    def run(batches):
        last, known = None, set()
        for batch in batches:
            c = {k: batch.column(k) for k in batch.schema.names}
            ra, rb = _regs(c["regs_a"].to_pylist()), _regs(c["regs_b"].to_pylist())
            likely = _passes((ra > rb).sum(axis=1), (ra < rb).sum(axis=1), c["size_a"].to_numpy(),
                             c["size_b"].to_numpy(), threshold)
            linked = []
            for i, a in enumerate(c["a"].to_pylist()):
                if not likely[i]:
                    linked.append(False)
                    continue
                if a != last:
                    last, known = a, shingles(c["text_a"][i].as_py(), width)
                other = shingles(c["text_b"][i].as_py(), width)
                both = len(known & other)
                linked.append(100 * both >= threshold * (len(known) + len(other) - both) > 0)
            yield pa.record_batch([c["a"], c["b"], pa.array(linked, pa.bool_())], names=["a", "b", "linked"])
    return run


def _confirmed(pairs: DataFrame, candidates: DataFrame, width: int, threshold: int) -> DataFrame:
    side = lambda s: candidates.select(
        F.col("node").alias(s), F.col("n_shingles").alias(f"size_{s}"), F.col("registers").alias(f"regs_{s}"),
        F.col("text").alias(f"text_{s}"))
    rows = pairs.join(side("b"), "b").join(side("a"), "a").select(
        "a", "b", "size_a", "size_b", "regs_a", "regs_b", "text_a", "text_b")
    return staged(arrow_map(rows, _verify(width, threshold), "a long, b long, linked boolean"), "verified")


def _pairs_of(rows: np.ndarray, other: np.ndarray | None, most: int = 1 << 16):
    """All pairs of ``rows`` (or of ``rows`` with ``other``), ``most`` or fewer at a time."""
    if other is None:
        if len(rows) <= 256:
            p, q = np.triu_indices(len(rows), 1)
            yield rows[p], rows[q]
            return
        for k in range(len(rows) - 1):
            yield np.full(len(rows) - k - 1, rows[k]), rows[k + 1:]
        return
    step = max(1, most // max(1, len(other)))
    for k in range(0, len(rows), step):
        x = rows[k:k + step]
        yield np.repeat(x, len(other)), np.tile(other, len(x))


def _rest_of_blocks(width: int, threshold: int):
    """Links across components within each bucket (or two blocks of a large one).

    Pairs that pass the estimate are compared on their shingle hashes; a pair whose
    components this task has linked already is left out, so a dense group gives as many
    rows as it has components, not as it has pairs.
    """
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["band_key", "i", "j", "part", "node"], kind="stable").reset_index(drop=True)
        regs, text = _regs(rows["registers"]), rows["text"]
        node, comp, size, band, part, i, j = (rows[c].to_numpy() for c in (
            "node", "comp", "n_shingles", "band", "part", "i", "j"))
        sets: dict[int, np.ndarray] = {}
        parent: dict[int, int] = {}
        links, waiting, n_waiting = [], [], 0

        def root(c: int) -> int:
            while (up := parent.get(c, c)) != c:
                parent[c] = c = parent.get(up, up)
            return c

        def hashes(row: int) -> np.ndarray:
            n = node[row]
            if n not in sets:
                sets[n] = shingle_hashes(text[row], width)
            return sets[n]

        def compare():
            a, b = (np.concatenate(x) for x in zip(*waiting))
            for at in range(0, len(a), 1 << 16):
                u, v = a[at:at + (1 << 16)], b[at:at + (1 << 16)]
                ok = (comp[u] != comp[v]) & (100 * np.minimum(size[u], size[v]) >=
                                             threshold * np.maximum(size[u], size[v]))
                u, v = u[ok], v[ok]
                if not len(u):
                    continue
                larger, smaller = (regs[u] > regs[v]).sum(axis=1), (regs[u] < regs[v]).sum(axis=1)
                # a pair is left to the first bucket that holds both
                same = (regs[u] == regs[v]).reshape(-1, BANDS, ROWS).all(axis=2)
                ok = (same.argmax(axis=1) == band[u]) & _passes(larger, smaller, size[u], size[v], threshold)
                for x, y in zip(u[ok].tolist(), v[ok].tolist()):
                    p, q = root(comp[x]), root(comp[y])
                    if p == q:
                        continue
                    both = len(np.intersect1d(hashes(x), hashes(y), assume_unique=True))
                    if 100 * both >= threshold * (size[x] + size[y] - both):
                        parent[max(p, q)] = min(p, q)
                        links.append((min(node[x], node[y]), max(node[x], node[y])))

        blocks = np.flatnonzero((np.diff(rows["band_key"]) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)) + 1
        for block in np.split(np.arange(len(rows)), blocks):
            first = block[0]
            left = block[part[block] == i[first]]
            for pair in _pairs_of(left, None if i[first] == j[first] else block[part[block] == j[first]]):
                waiting.append(pair)
                n_waiting += len(pair[0])
                if n_waiting >= 1 << 16:
                    compare()
                    waiting, n_waiting = [], 0
        if waiting:
            compare()
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")
    return run


def _rest(members: DataFrame, candidates: DataFrame, labels: DataFrame, width: int, threshold: int) -> DataFrame:
    """Pairs that link components within buckets that hold several.

    Pairs with a bucket's least member have all been verified, so it is left out.
    """
    placed = (members.filter("node <> leader").join(labels.withColumnRenamed("label", "comp"), "node", "left")
              .withColumn("comp", F.coalesce("comp", "node")))
    split = (placed.groupBy("band_key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"),
                                            F.count(F.lit(1)).alias("n"))
             .filter("low <> high").select("band_key", "n", F.ceil(F.col("n") / BLOCK_MEMBERS).alias("parts")))
    split = staged(split, "split-buckets")
    groups = -(-(split.agg(F.sum("n")).first()[0] or 1) // GROUP_MEMBERS)
    rows = (placed.join(split, "band_key")
            .withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")))
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
            .withColumns({"i": F.least("part", "other"), "j": F.greatest("part", "other")})
            .join(candidates.select("node", "n_shingles", "registers", "text"), "node")
            .withColumn("group", F.pmod(F.xxhash64("band_key", "i", "j"), F.lit(groups)))
            .select("group", "band_key", "band", "i", "j", "part", "node", "comp", "n_shingles", "registers", "text"))
    return rows.groupBy("group").applyInPandas(_rest_of_blocks(width, threshold), "a long, b long").distinct()


def _verdicts(docs: DataFrame, width: int, threshold: int) -> DataFrame:
    """Per row of ``docs``: doc_id, text_key, n_shingles, component_id, kept."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key"))
    rows = staged(arrow_map(texts, _sketch(width),
                            "doc_id long, text_key long, n_shingles long, set_key binary, registers binary, "
                            "bands array<long>"), "sketches")
    named = rows.filter("doc_id is not null and set_key is not null")
    classes = staged(named.groupBy("set_key").agg(F.min("doc_id").alias("node")), "classes")
    first = (named.join(classes.withColumnRenamed("node", "doc_id"), ["set_key", "doc_id"]).groupBy("doc_id")
             .agg(F.min(F.struct("set_key", "text_key", "n_shingles", "registers", "bands")).alias("c"))
             .select(F.col("doc_id").alias("node"), "c.text_key", "c.n_shingles", "c.registers", "c.bands"))
    first = staged(first, "class-sketches")
    bands = first.select("node", F.posexplode("bands").alias("band", "band_key"))
    buckets = (bands.groupBy("band_key").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("n"))
               .filter("n > 1").select("band_key", "leader"))
    members = staged(bands.join(buckets, "band_key"), "members")
    shared = first.drop("bands").join(members.select("node").distinct(), "node", "left_semi")
    candidates = staged(texts.withColumnRenamed("doc_id", "node").join(shared, ["node", "text_key"])
                        .dropDuplicates(["node"]), "candidates")
    pairs = members.filter("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    verified = _confirmed(pairs, candidates, width, threshold)
    labels = connected_components(verified.filter("linked").select("a", "b"))
    rest = staged(_rest(members, candidates, labels, width, threshold), "rest")
    if not rest.isEmpty():
        verified = verified.unionByName(_confirmed(rest, candidates, width, threshold))
        labels = connected_components(verified.filter("linked").select("a", "b"))
    named = classes.join(labels, "node", "left").select("set_key", F.coalesce("label", "node").alias("class_label"))
    out = rows.select("doc_id", "text_key", "n_shingles", "set_key").join(named, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("class_label", "doc_id"))
    return out.select("doc_id", "text_key", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))


def near_duplicates(docs: DataFrame, width: int = 5, threshold: int = 80) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (least doc_id linked), kept.

    ``width`` words make a shingle; ``threshold`` is the least similarity in percent.
    """
    return _verdicts(docs, width, threshold).drop("text_key")


def drop_near_copies(docs: DataFrame, width: int = 5, threshold: int = 80) -> DataFrame:
    """``docs`` with one document of each group of near copies; all columns stay.

    The verdict is the row's, not the id's.  Ids are taken to be unique: of an id that is the least of
    several sets of shingles, only one set (the least by its key) is compared with others.
    """
    keep = (_verdicts(docs, width, threshold).filter("kept")
            .select(F.col("doc_id").alias("__keep_id"), F.col("text_key").alias("__keep_key")).distinct())
    rows = docs.join(keep, docs["doc_id"].eqNullSafe(keep["__keep_id"])
                     & (F.xxhash64(docs["text"]) == keep["__keep_key"]), "left_semi")
    return rows.dropDuplicates(["doc_id", "text"])
