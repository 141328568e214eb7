"""Centroid clustering: Lloyd's rounds with the dimensions dealt out in shards.

Vectors are packed into blocks of up to ``BLOCK`` rows and each block is cut into
column slices, one for each shard of dimensions.  A round is one job:

* a task reads a block's slice and the shard's own centroid slice, and computes the
  exact partial squared distances of all rows to all centroids;
* partial distances are added by block (four matrices a block, whatever the data),
  which gives every row's distance and its argmin;
* labels go back to the slices by block; each shard adds up its own components by
  cluster, tasks fold them first, and its centroid slice becomes floor(sum / count).

Centroids (k x width integers) pass through the driver, nothing else.  Everything
is integer arithmetic, so the result doesn't depend on how rows are dealt out.

Defined results
---------------
* vectors that are null, of another width, or hold a null or non-finite component
  are left out; components beyond ``LARGEST`` in size count as that, so that squared
  distances fit a long;
* repeated vectors and ids are rows of their own; of rows whose ids hash alike the
  lesser vector starts first; a null id hashes as ``2:``;
* fewer kept vectors than centroids: each starts one; an empty table gives no rows;
* an empty cluster keeps its centroid; ties go to the smaller number;
* further columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, staged

#: Rows of a block; a block's distances to 40 centroids take 1.3 MB.
BLOCK = 4096
#: Column slices that the dimensions are dealt into.
SHARDS = 4
#: Largest size of a component after scaling.
LARGEST = 2**26
#: Fixed value: what a component is multiplied by before it is floored.
SCALE = 256

RESULT = ("vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, "
          "centroid_sha256 string")


def _pack(m: np.ndarray) -> bytes:
    """Integers in the narrowest type that holds them, led by that type's width."""
    top = int(np.abs(m).max(initial=0))
    size = next(s for s in (1, 2, 4, 8) if top < 1 << (8 * s - 1))
    return bytes([size]) + m.astype(f"<i{size}").tobytes()


def _unpack(data: bytes, columns: int) -> np.ndarray:
    return np.frombuffer(data, f"<i{data[0]}", offset=1).astype(np.int64).reshape(-1, columns)


def integers(vectors: DataFrame, column: str, width: int) -> DataFrame:
    """vec_id and ``v``: the kept vectors as integers floor(256 * x)."""
    scaled = F.transform(column, lambda x: F.floor(
        F.greatest(F.least(F.lit(SCALE) * x.cast("double"), F.lit(float(LARGEST))), F.lit(-float(LARGEST)))))
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.filter((F.size(column) == width) & finite)
            .select(F.col("vec_id").cast("long").alias("vec_id"), scaled.cast("array<bigint>").alias("v")))


def _blocks(rows: DataFrame, bounds: list[tuple[int, int]]) -> DataFrame:
    """(block, shard, ids, x): slices of each block; ``ids`` only with shard 0."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                m = part.column("v").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                ids = part.column("vec_id").to_pylist()
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([f"{task}-{n}"] * len(bounds)),
                    "shard": pa.array(range(len(bounds)), pa.int32()),
                    "ids": pa.array([ids] + [None] * (len(bounds) - 1), pa.list_(pa.int64())),
                    "x": pa.array([_pack(m[:, a:b]) for a, b in bounds], pa.binary())})
                n += 1

    return staged(arrow_map(rows, pack, "block string, shard int, ids array<bigint>, x binary"), "blocks")


def _assign(blocks: DataFrame, centroids: np.ndarray, bounds: list[tuple[int, int]]) -> DataFrame:
    """(block, labels, distances) by adding the shards' partial distances."""
    k = len(centroids)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, shard, x in zip(*(batch.column(c).to_pylist() for c in ("block", "shard", "x"))):
                a, b = bounds[shard]
                m, c = _unpack(x, b - a), centroids[:, a:b]
                d = (m * m).sum(1)[:, None] - 2 * (m @ c.T) + (c * c).sum(1)[None, :]
                yield pa.RecordBatch.from_pydict({"block": [block], "part": pa.array([_pack(d)], pa.binary())})

    def nearest(group: pd.DataFrame) -> pd.DataFrame:
        d = sum(_unpack(p, k) for p in group["part"])
        label = d.argmin(1)
        return pd.DataFrame({"block": group["block"].iloc[:1], "labels": [_pack(label[:, None])],
                             "distances": [_pack(d[np.arange(len(d)), label][:, None])]})

    parts = arrow_map(blocks.select("block", "shard", "x"), partial, "block string, part binary")
    return parts.groupBy("block").applyInPandas(nearest, "block string, labels binary, distances binary")


def _update(blocks: DataFrame, labels: DataFrame, centroids: np.ndarray, bounds: list[tuple[int, int]]) -> np.ndarray:
    """Each shard's own slice of the next centroids; an empty cluster keeps its own."""
    k = len(centroids)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {s: np.zeros((k, b - a), np.int64) for s, (a, b) in enumerate(bounds)}
        counts = {s: np.zeros(k, np.int64) for s in sums}
        for batch in batches:
            for shard, x, packed in zip(*(batch.column(c).to_pylist() for c in ("shard", "x", "labels"))):
                label = _unpack(packed, 1)[:, 0]
                a, b = bounds[shard]
                np.add.at(sums[shard], label, _unpack(x, b - a))
                counts[shard] += np.bincount(label, minlength=k)
        for s, (a, b) in enumerate(bounds):
            c, d = np.nonzero(np.broadcast_to(counts[s][:, None], sums[s].shape))
            if len(c):
                yield pa.RecordBatch.from_pydict({"cluster": pa.array(c, pa.int32()), "dim": pa.array(d + a, pa.int32()),
                                                  "total": sums[s][c, d], "n": counts[s][c]})

    joined = blocks.select("block", "shard", "x").join(labels.select("block", "labels"), "block")
    folded = (arrow_map(joined.select("shard", "x", "labels"), fold, "cluster int, dim int, total bigint, n bigint")
              .groupBy("cluster", "dim").agg(F.sum("total").alias("total"), F.sum("n").alias("n")))
    after = centroids.copy()
    for row in folded.collect():  # k x width rows
        after[row["cluster"], row["dim"]] = row["total"] // row["n"]
    return after


def cluster(vectors: DataFrame, column: str = "embedding", width: int = 64, k: int = 40, rounds: int = 5,
            seed: str = "2") -> DataFrame:
    """Per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    spark = vectors.sparkSession
    rows = integers(vectors, column, width)
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = rows.orderBy(key, "v").limit(k).collect()
    if not first:
        return spark.createDataFrame([], RESULT)
    centroids = np.array([r["v"] for r in first], np.int64)
    step = -(-width // SHARDS)
    bounds = [(a, min(a + step, width)) for a in range(0, width, step)]
    blocks = _blocks(rows, bounds)
    for _ in range(rounds):
        centroids = _update(blocks, _assign(blocks, centroids, bounds), centroids, bounds)

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, label, d in zip(*(batch.column(c).to_pylist() for c in ("ids", "labels", "distances"))):
                yield pa.RecordBatch.from_pydict({"vec_id": pa.array(ids, pa.int64()),
                                                  "cluster": _unpack(label, 1)[:, 0].astype(np.int32),
                                                  "distance": _unpack(d, 1)[:, 0]})

    last = blocks.filter("ids is not null").select("block", "ids").join(_assign(blocks, centroids, bounds), "block")
    found = staged(arrow_map(last.select("ids", "labels", "distances"), rows_of,
                             "vec_id bigint, cluster int, distance bigint"), "clusters")
    sums = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    about = spark.createDataFrame(
        [(c, s, sum(sums.values()), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
         for c, s in sums.items()], "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia",
                                                            "inertia", "centroid_sha256")


def _round_sql(r: int) -> str:
    return f"""
        d{r} AS MATERIALIZED (
            SELECT rid, c, list_sum(list_transform(list_zip(v, cv), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
            FROM kept, c{r}),
        a{r} AS MATERIALIZED (
            SELECT rid, first(c ORDER BY d, c) AS c, min(d) AS d FROM d{r} GROUP BY rid)"""


def _next_sql(r: int) -> str:
    return f"""
        s{r} AS (
            SELECT c, i, sum(x) AS s, count(*) AS n
            FROM (SELECT c, unnest(v) AS x, unnest(range(1, 65)) AS i FROM a{r} JOIN kept USING (rid)) GROUP BY c, i),
        m{r} AS (SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS v FROM s{r} GROUP BY c),
        c{r + 1} AS MATERIALIZED (SELECT c{r}.c, coalesce(m{r}.v, cv) AS cv FROM c{r} LEFT JOIN m{r} USING (c))"""


#: The contract's clustering, round by round.
ORACLE = """
        WITH kept AS MATERIALIZED (
            SELECT row_number() OVER () AS rid, vec_id,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
            FROM embeddings
            WHERE len(embedding) = 64
              AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
        c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('2:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS c, v AS cv
            FROM kept QUALIFY c < 40),""" + ",".join(
    [_round_sql(r) + "," + _next_sql(r) for r in range(5)]) + "," + _round_sql(5) + """
        SELECT vec_id, a5.c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY a5.c))::BIGINT AS cluster_inertia,
               (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(cv, ',')) AS centroid_sha256
        FROM a5 JOIN kept USING (rid) JOIN c5 ON a5.c = c5.c"""
