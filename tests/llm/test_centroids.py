"""Centroid clustering against a plain loop, and on odd vectors."""

import hashlib
import math
import random

from pyspark.sql import functions as F

from keyedlake.llm import centroids, queries
from keyedlake.llm.common import table

SF = "/root/testdata/sf0.001"


def plain(rows, k, rounds, width=64, seed="2"):
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid hash) by the contract's words."""
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    cs = [v for _, v in order[:k]]
    far = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b))
    assign = lambda: [min((far(v, c), j) for j, c in enumerate(cs)) for _, v in kept]
    for _ in range(rounds):
        to = assign()
        for j in range(len(cs)):
            own = [v for (_, v), (_, c) in zip(kept, to) if c == j]
            if own:
                cs[j] = [sum(col) // len(own) for col in zip(*own)]
    to = assign()
    sums = {j: sum(d for d, c in to if c == j) for j in range(len(cs))}
    return sorted(((i, c, d, sums[c], sum(sums.values()), hashlib.sha256(",".join(map(str, cs[c])).encode()).hexdigest())
                   for (i, _), (d, c) in zip(kept, to)), key=str)


def test_clusters_match_a_plain_loop(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF, "embeddings").collect()]
    assert sorted(map(tuple, queries.op13_centroids(spark, SF).collect()), key=str) == plain(rows, 40, 5)


def test_small_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(centroids, "BLOCK", 7)
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF, "embeddings").limit(100).collect()]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    got = centroids.cluster(df, k=6, rounds=2)
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows, 6, 2)


def test_odd_vectors(spark):
    rnd = random.Random(5)
    some = [[rnd.uniform(-2, 2) for _ in range(4)] for _ in range(30)]
    rows = [(i, v) for i, v in enumerate(some)] + [
        (100, None), (101, []), (102, some[0][:3]), (103, some[0] + [1.0]), (104, [1.0, None, 2.0, 3.0]),
        (105, [1.0, float("nan"), 2.0, 3.0]), (106, [1.0, float("inf"), 2.0, 3.0]), (None, some[1]), (None, some[2]),
        (3, some[3]), (3, some[3]), (3, some[4]), (107, [0.0, -0.0, 1e-30, -1e-30])]
    rows += [(200 + i, some[5]) for i in range(60)]  # one vector a great many times
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns(
        {c: F.lit("x") for c in ("block", "shard", "cluster", "distance", "v", "ids", "labels", "n")})
    got = sorted(map(tuple, centroids.cluster(df, width=4, k=5, rounds=3).collect()), key=str)
    assert got == plain(rows, 5, 3, width=4)
    few = centroids.cluster(df.filter("vec_id < 3"), width=4, k=40, rounds=2).collect()
    assert sorted(r.distance for r in few) == [0, 0, 0]  # a centroid each
    none = centroids.cluster(df.filter("1 = 0"), width=4)
    assert none.collect() == [] and none.columns == few[0].__fields__
    huge = spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 0.0])], "vec_id long, embedding array<double>")
    far = centroids.cluster(huge, width=2, k=1, rounds=0).collect()
    assert {r.distance for r in far} == {0, (2 * centroids.LARGEST) ** 2}
