"""Drift between dates: planted shifts are found, equal dates are silent, figures equal numpy's."""

import math
import random
from decimal import Decimal

import numpy as np
from pyspark.sql import functions as F

from ledgerstrata.operators.drift import drift, rule_changes, store_results, value_bucket, value_counts

from .conftest import rows

SCHEMA = "transaction_type string, booked_date string, amount decimal(18,2)"


def layer(spark, data):
    df = spark.createDataFrame([(t, d, None if a is None else Decimal(a)) for t, d, a in data], SCHEMA)
    return df.withColumn("booked_date", F.col("booked_date").cast("date"))


def amounts(rng, n, mean):
    return [f"{rng.lognormvariate(mean, 1):.2f}" for _ in range(n)]


def bucket(a):
    cents = str(abs(int(round(Decimal(a) * 100))))
    sign = (Decimal(a) > 0) - (Decimal(a) < 0)
    return sign * (1000 * len(cents) + int(cents[:3].ljust(3, "0")))


def test_planted_shift_is_found_and_equal_dates_are_silent(spark):
    rng = random.Random(5)
    data = []
    for day in range(1, 9):
        data += [("fee", f"2024-01-{day:02d}", a) for a in amounts(rng, 800, 4 if day < 6 else 5.5)]
        data += [("deposit", f"2024-01-{day:02d}", a) for a in amounts(rng, 800, 6)]
    found = drift(value_counts(layer(spark, data))).collect()
    assert len(found) == 14
    assert [(r.transaction_type, str(r.booked_date)) for r in found if r.drifted] == [("fee", "2024-01-06")]


def test_figures_equal_a_plain_computation(spark):
    rng = random.Random(6)
    groups = {d: [rng.choice(["-", ""]) + a for a in amounts(rng, n, m)] for d, n, m in (("2024-01-01", 300, 3), ("2024-01-04", 170, 4))}
    data = [("fee", d, a) for d, g in groups.items() for a in g] + [("fee", "2024-01-01", None), (None, "2024-01-01", "1")]
    (r,) = drift(value_counts(layer(spark, data))).collect()
    a, b = (np.array([bucket(x) for x in g]) for g in groups.values())
    points = np.unique(np.concatenate([a, b]))
    ks = max(abs((a <= x).mean() - (b <= x).mean()) for x in points)
    coarse = lambda v: np.sign(v) * (np.abs(v) // 100)
    bins = np.unique(coarse(points))
    p, q = (np.array([(coarse(v) == x).sum() + 0.5 for x in bins]) / (len(v) + 0.5 * len(bins)) for v in (a, b))
    assert abs(r.ks - ks) < 1e-8 and abs(r.psi - ((q - p) * np.log(q / p)).sum()) < 2e-6
    assert abs(r.ks_limit - math.sqrt(-math.log(0.0005) / 2) * math.sqrt(470 / (300 * 170))) < 1e-8
    assert (r.previous_count, r.record_count, str(r.previous_date)) == (300, 170, "2024-01-01")


def test_buckets_never_decrease(spark):
    values = sorted({round(random.Random(7).uniform(-1, 1) * 10**k, 2) for k in range(7) for _ in range(1)} | {0.0, 0.01, -0.01, 0.1, 9.99, 10.0, -10.0, 99999.99, 100000.0})
    df = layer(spark, [("x", None, f"{v:.2f}") for v in values])
    got = [b for _, b in sorted(rows(df.select("amount", value_bucket(F.col("amount")))))]
    assert got == sorted(got) and got == [bucket(f"{v:.2f}") for v in values]


def test_empty_layers_and_single_dates(spark):
    assert drift(value_counts(layer(spark, [("fee", "2024-01-01", "1.00")]))).count() == 0
    assert drift(value_counts(layer(spark, [("fee", "2024-01-01", "1.00")]).limit(0))).count() == 0


def test_history_of_results(spark, tmp_path):
    path = str(tmp_path / "history")
    report = lambda n: spark.createDataFrame([("silver", "id_unique", n)], "layer string, rule string, failing long")
    for run, n in (("2024-01-01", 3), ("2024-01-02", 9), ("2024-01-03", 2), ("2024-01-02", 5)):
        store_results(report(n), path, run)
    got = rule_changes(spark.read.parquet(path)).orderBy("run").collect()
    assert [(r.failing, r.previous_failing, r.worse) for r in got] == [(3, None, False), (5, 3, True), (2, 5, False)]
