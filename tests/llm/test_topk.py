"""Exact top-k against all inner products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerstrata.llm import topk
from ledgerstrata.llm.topk import exact_top_k


def plain(rows, k, scale=1024):
    """Sorted answers of the queries among (id, vector) rows: ids that ten divides."""
    usable = [
        (i, np.floor(np.array(v, float) * scale).astype(object))
        for i, v in rows
        if v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for q, a in usable:
        if q is None or q % 10:
            continue
        near = sorted(
            ((-int((a * b).sum()), i is None, i or 0) for i, b in usable if i != q and len(a) == len(b))
        )
        out += [(q, r + 1, None if m else i, -s) for r, (s, m, i) in enumerate(near[:k])]
    return sorted(out, key=repr)


def answers(df, k):
    found = exact_top_k(df.where("vec_id % 10 = 0"), df, k=k)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, found.collect()), key=repr)


def table(spark, rows, parts=6):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(parts)


@pytest.fixture(params=["one pass", "many passes and tiles"])
def sizes(request, monkeypatch):
    if request.param != "one pass":
        monkeypatch.setattr(topk, "PASS_QUERIES", 16)
        monkeypatch.setattr(topk, "TILE_QUERIES", 7)


def test_equals_all_products(spark, sizes):
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (600, 8))
    x[::3] = x[0]  # a hot vector, whose copies tie
    x[1::4] = np.round(x[1::4])
    rows = [(int(i), [float(v) for v in row]) for i, row in zip(rng.permutation(600), x)]
    for k in (1, 10):
        assert answers(table(spark, rows), k) == plain(rows, k)


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (10, [1.0, 2.0]), (None, [5.0, 5.0]), (None, [1.0, 2.0]), (20, None),
        (30, [None, 1.0]), (40, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (50, []), (60, [1.0]), (7, [2.0]),
        (3, [1.0, 2.0]), (3, [1.0, 2.0]), (-10, [-1.0, 0.0]), (1, [1e5, -1e5]),
    ]
    df = table(spark, rows)
    for name in ("rank", "score", "query_id", "shard", "query", "block"):
        df = df.withColumn(name, F.lit("extra"))
    assert answers(df, 3) == plain(rows, 3)
    assert answers(df, 100) == plain(rows, 100)
    assert answers(df.limit(0), 3) == []


def test_large_numbers_are_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(v) for v in rng.integers(-(2**16), 2**16, 40)]) for i in range(60)]
    assert max(abs(r[3]) for r in plain(rows, 60)) > 2**53
    assert answers(table(spark, rows), 60) == plain(rows, 60)


def test_copies_that_cannot_enter_a_list_are_left_out():
    matrix = np.zeros((1000, 3), np.int64)
    ids = np.repeat(np.arange(100), 10)
    kept = topk.relevant_copies(matrix, ids, np.zeros(1000, bool), 4)
    assert ids[kept].tolist() == [0] * 4 + [1] * 4


def test_no_candidates_are_shuffled(spark):
    rows = [(i, [float(i), 1.0]) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    plan = exact_top_k(df.where("vec_id % 10 = 0"), df, k=2)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("WindowGroupLimit") >= 2
    assert plan.index("MapInArrow") > plan.rindex("Exchange")
