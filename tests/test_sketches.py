"""Merged percentiles keep their promised rank error for any span of dates."""

import pytest
from pyspark.sql import functions as F

from ledgerstrata.operators.percentiles import silver_percentiles
from ledgerstrata.operators.sketches import (
    NAMES, RANK_ERROR, SHARES, daily_sketches, merged_percentiles, rank_errors,
)
from ledgerstrata.sources.layers import read_layer, write_layer

from .conftest import rows
from .test_plans import plan


def test_small_groups_are_exact(spark, stored, tmp_path):
    path = str(tmp_path / "sketches")
    write_layer(daily_sketches(stored.silver), path)
    sketches = read_layer(spark, path)
    got = merged_percentiles(sketches)
    assert sorted(rows(got, "transaction_type", *NAMES)) == sorted(
        rows(silver_percentiles(stored.silver), "transaction_type", *NAMES)
    )
    # Reading a span of dates reads their sketches only.
    some = merged_percentiles(read_layer(spark, path, dates=["2024-01-02", "2024-01-03"]))
    part = stored.silver.where(F.col("booked_date").isin("2024-01-02", "2024-01-03"))
    assert sorted(rows(some, "transaction_type", *NAMES)) == sorted(
        rows(silver_percentiles(part), "transaction_type", *NAMES)
    )
    assert "amount:" not in plan(some) and "PartitionFilters: [" in plan(some)


@pytest.mark.parametrize("amount", ["(id * 7919) % 1000003", "pow(rand(5), 8) * 1000000", "id % 3", "-id"])
def test_ranks_of_many_rows(spark, amount):
    silver = spark.range(300_000).selectExpr(
        "if(id % 3 = 0, 'fee', 'payment') AS transaction_type", f"CAST({amount} AS DECIMAL(18,2)) AS amount",
        "id % 10 <> 0 AS amount_valid", "date_add(DATE'2024-01-01', CAST(id % 25 AS INT)) AS booked_date",
    )
    merged = merged_percentiles(daily_sketches(silver))
    off = rank_errors(silver, merged).collect()
    assert sum(r.amounts for r in off) == 270_000
    assert all(r[n] <= RANK_ERROR for r in off for n in NAMES)


def test_rank_errors_see_wrong_values(spark):
    silver = spark.range(1, 101).selectExpr(
        "'fee' AS transaction_type", "CAST(id AS DECIMAL(18,2)) AS amount", "true AS amount_valid"
    )
    given = spark.createDataFrame([("fee", 25, 53, 75, 90)], "transaction_type string, p25 int, median int, p75 int, p95 int")
    (r,) = rank_errors(silver, given).collect()
    assert [round(r[n], 4) for n in NAMES] == [0.0, 0.02, 0.0, 0.05] and len(SHARES) == 4


def test_null_amounts_and_empty_layers(make):
    silver = make.silver(("a", None, None, "fee", "true", "2024-01-01"), ("b", None, "5.00", "fee", "true", "2024-01-01"))
    assert rows(merged_percentiles(daily_sketches(silver))) == [("fee", 1, 5.0, 5.0, 5.0, 5.0)]
    assert rows(merged_percentiles(daily_sketches(make.silver()))) == []
