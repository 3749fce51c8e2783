"""Running totals over several months, corrected date by date, against one window over all dates."""

import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerstrata.plans.carries import daily_net, read_running, store_running

from .conftest import rows
from .test_plans import plan

BY = ("transaction_type",)


@pytest.fixture(scope="module")
def values(spark):
    """Five months with gaps, three types of which one is NULL and one skips months."""
    return spark.range(150).selectExpr("date_add(DATE'2024-01-15', CAST(id AS INT)) AS booked_date", "id").selectExpr(
        "booked_date", "explode(array('fee', 'payment', NULL)) AS transaction_type", "id"
    ).where("id % 7 <> 3 AND (transaction_type <=> 'fee' OR month(booked_date) <> 3)").selectExpr(
        "booked_date", "transaction_type", "CAST((id * 37) % 101 - 50.25 AS DECIMAL(38,2)) AS value"
    )


def windowed(values, by):
    w = Window.partitionBy(*by).orderBy("booked_date")
    return values.select(
        "booked_date", *by, "value",
        F.sum("value").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("running"),
        F.lag("value").over(w).alias("previous"),
    )


def same(got, want):
    return sorted(rows(got.select(want.columns)), key=repr) == sorted(rows(want), key=repr)


def files(path):
    return {
        os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
        for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")
    }


def test_a_correction_rewrites_the_suffix_only(spark, values, tmp_path):
    path = str(tmp_path / "r")
    store_running(values, path, BY)
    assert same(read_running(spark, path, BY), windowed(values, BY))
    before = files(path)
    fixed = values.withColumn(
        "value", F.when(F.col("booked_date") == "2024-04-04", 1000).otherwise(F.col("value")).cast("decimal(38,2)")
    ).where("booked_date <> DATE'2024-04-10'")
    store_running(fixed, path, BY, dates=["2024-04-04", "2024-04-10"])
    assert same(read_running(spark, path, BY), windowed(fixed, BY))
    kept = {f for f, at in files(path).items() if before.get(f) == at}
    months = lambda part: {f.split("month=")[1][:7] for f in kept if f"/{part}/" in f}
    assert months("rows") == {"2024-01", "2024-02", "2024-03", "2024-05", "2024-06"}
    assert months("carries") == {"2024-01", "2024-02", "2024-03"}
    some = read_running(spark, path, BY, dates=["2024-05-01", "2024-05-02"])
    want = windowed(fixed, BY).where("booked_date IN (DATE'2024-05-01', DATE'2024-05-02')")
    assert same(some, want)


def test_a_month_may_go_and_come_back(spark, values, tmp_path):
    path = str(tmp_path / "r")
    one = values.where("transaction_type = 'payment'").select("booked_date", "value")
    store_running(one, path)
    less = one.where("month(booked_date) <> 2")
    store_running(less, path, dates=["2024-02-10"])
    assert same(read_running(spark, path), windowed(less, ()))
    store_running(one, path, dates=["2024-02-01"])
    assert same(read_running(spark, path), windowed(one, ()))


def test_no_window_over_all_dates(spark, sample, tmp_path):
    store_running(daily_net(sample.silver_clean), str(tmp_path / "r"))
    text = plan(read_running(spark, str(tmp_path / "r")))
    assert "Window" not in text and "SinglePartition" not in text


def test_empty(spark, values, tmp_path):
    store_running(values.where("false"), str(tmp_path / "r"), BY)
    store_running(values, str(tmp_path / "r"), BY)
    assert read_running(spark, str(tmp_path / "r"), BY).count() == values.count()
