"""Shallot search against plain assignment of all vectors in every round."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerstrata.llm import clustering
from ledgerstrata.llm.clustering import Centroids, cluster_vectors, shallot, squared

COLUMNS = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def plain_clusters(ids, x, k, rounds, seed=3):
    def digest(i):
        return hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()

    start = sorted((i for i in range(len(ids)) if ids[i] is not None), key=lambda i: (digest(ids[i]), x[i].tolist()))
    c = x[start[:k]].copy()
    if not len(c):
        return set()

    def assigned():
        d = np.stack([((x - v) ** 2).sum(axis=1) for v in c], axis=1)
        return d.argmin(axis=1), d.min(axis=1)

    for _ in range(rounds):
        own, _ = assigned()
        for j in range(len(c)):
            if (own == j).any():
                c[j] = x[own == j].sum(axis=0) // (own == j).sum()
    own, d = assigned()
    of = [hashlib.sha256(",".join(map(str, v.tolist())).encode()).hexdigest() for v in c]
    return sorted(
        (ids[i] is None, ids[i] or 0, int(own[i]), int(d[i]), int(d[own == own[i]].sum()), int(d.sum()), of[own[i]])
        for i in range(len(ids))
    )


def result(df):
    assert df.columns == COLUMNS
    return sorted((r.vec_id is None, r.vec_id or 0, *tuple(r)[1:]) for r in df.collect())


def table(spark, ids, x, width="float"):
    rows = [(i, [float(v) / 1024 for v in row]) for i, row in zip(ids, x)]
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{width}>")


@pytest.mark.parametrize("k,length,spread", [(8, 64, 300), (5, 2, 3), (20, 3, 40), (1, 4, 9)])
def test_equals_plain_rounds(spark, k, length, spread):
    rng = np.random.default_rng(k)
    x = rng.integers(-spread, spread, (700, length))
    x[::3] = x[0]  # a third are copies of one vector
    x[1::5] += rng.integers(0, 2, x[1::5].shape)
    ids = list(range(700))
    got = cluster_vectors(table(spark, ids, x).repartition(5), k=k, rounds=6, length=length)
    assert result(got) == plain_clusters(ids, x, k, 6)


def test_search_is_exact_under_ties_and_saves_distances():
    rng = np.random.default_rng(2)
    for spread in (2, 5, 1000):
        x = rng.integers(-spread, spread, (2000, 3))
        at = x[:30].copy()
        c = Centroids(at, np.zeros(30))
        n = len(x)
        near, second = np.zeros(n, np.int64), np.ones(n, np.int64)
        upper, lower = np.full(n, np.inf), np.zeros(n)
        total = 0
        for _ in range(12):
            total += shallot(x, near, second, upper, lower, c)
            d = np.stack([squared(x, v) for v in c.at], axis=1)
            assert (near == d.argmin(axis=1)).all()
            assert (upper >= np.sqrt(d.min(axis=1)) * (1 - 1e-12)).all()
            d[np.arange(n), near] = np.iinfo(np.int64).max
            assert (lower <= np.sqrt(d.min(axis=1)) * (1 + 1e-12)).all()
            new = c.at.copy()
            for j in range(30):
                if (near == j).any():
                    new[j] = x[near == j].sum(axis=0) // (near == j).sum()
            c = Centroids(new, np.sqrt(squared(new, c.at).astype(float)) * clustering.UP)
        assert total < 0.5 * 12 * n * 30


def test_odd_rows(spark):
    one = [0.5, -0.25]
    rows = [
        (1, one), (1, one), (2, None), (3, [0.1, None]), (4, [float("nan"), 0.0]), (5, [float("inf"), 0.0]),
        (6, [1.0]), (7, []), (None, [3.0, 3.0]), (8, [40.0, -40.0]), (9, [100.0, 1.5]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for name in ("nearest", "cluster", "hash", "vector", "components"):
        df = df.withColumn(name, F.lit("extra"))
    ids = [1, 1, None, 8, 9]
    x = np.array([[512, -256], [512, -256], [3072, 3072], [40960, -40960], [102400, 1536]])
    for k in (2, 8):
        assert result(cluster_vectors(df, k=k, rounds=3, length=2)) == plain_clusters(ids, x, k, 3)
    assert cluster_vectors(df.limit(0), length=2).collect() == []
    assert cluster_vectors(df.where("vec_id IS NULL"), length=2).collect() == []
    with pytest.raises(Exception, match="64-bit"):
        cluster_vectors(spark.createDataFrame([(1, [1e15, 0.0])], "vec_id long, embedding array<double>"), length=2)


def test_scratch_of_old_rounds_is_deleted(spark):
    from ledgerstrata.sources import scratch

    before = len(scratch._handed_out)
    x = np.random.default_rng(0).integers(-50, 50, (200, 4))
    cluster_vectors(table(spark, list(range(200)), x), k=4, rounds=5, length=4)
    assert len(scratch._handed_out) == before + 1
