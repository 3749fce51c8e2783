"""Bucketed layers: plans without a shuffle by id, dated replacement, hot buckets."""

import re

import pytest

from ledgerstrata.operators import reconcile
from ledgerstrata.sources import buckets
from ledgerstrata.sources.buckets import (
    bucket_bytes, bucket_count, is_balanced, read_colocated, replace_dates, table_path, write_bucketed,
)

from .conftest import rows
from .test_plans import plan

ID = "transaction_id"


@pytest.fixture(scope="module")
def tables(spark, sample, tmp_path_factory):
    root = tmp_path_factory.mktemp("buckets")
    for name, df in (("bronze", sample.bronze), ("silver", sample.silver)):
        spark.sql(f"DROP TABLE IF EXISTS default.{name}_b")
        write_bucketed(df, f"default.{name}_b", str(root / name), 4)
    return "default.bronze_b", "default.silver_b"


OPERATORS = [
    reconcile.recon_layer_counts,
    reconcile.recon_missing_in_silver,
    reconcile.recon_amount_discrepancy,
    reconcile.recon_type_mismatch,
    reconcile.matched_by_type,
]


@pytest.mark.parametrize("operator", OPERATORS)
def test_joins_by_id_shuffle_no_id(operator, spark, tables, stored):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = operator(*read_colocated(spark, *tables))
        got = sorted(rows(df), key=repr)
        text = plan(df)
        shuffled = plan(operator(stored.bronze, stored.silver))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    exchanges = lambda t: re.findall(r"Exchange hashpartitioning\(([^)]*)", t)
    assert any(ID in keys for keys in exchanges(shuffled))
    assert not any(ID in keys for keys in exchanges(text))
    assert "SortMergeJoin" in text and "BroadcastExchange" not in text
    assert got == sorted(rows(operator(stored.bronze, stored.silver)), key=repr)


def test_rows_and_files(spark, tables, sample):
    assert sorted(rows(spark.table(tables[0])), key=repr) == sorted(rows(sample.bronze), key=repr)
    assert bucket_count(spark, tables[0]) == 4
    sizes = rows(bucket_bytes(spark, table_path(spark, tables[0])))
    assert sorted(b for b, _ in sizes) == [0, 1, 2, 3] and all(n > 0 for _, n in sizes)


def test_dates_are_replaced_in_their_buckets(spark, make, tmp_path):
    name = "default.replaced_b"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    row = lambda i, day: (f"t{i}", f"{day} 08:00:00", f"{i}.00", "fee", day)
    days = ["2024-01-01", "2024-01-02", "2024-01-03"]
    write_bucketed(make.bronze(*[row(i, d) for d in days for i in range(20)]), name, str(tmp_path / "b"), 4)
    new = make.bronze(*[row(i, days[0]) for i in range(5)], *[row(i, days[2]) for i in range(50)])
    replace_dates(new, name, days[:2])
    got = rows(spark.table(name), "booked_date")
    assert [got.count((d,)) for d in days] == [5, 0, 20]
    # Still bucketed: grouping by id reads buckets where they lie.
    grouped = spark.table(name).groupBy(ID).count()
    assert "Exchange" not in plan(grouped) and grouped.count() == 20
    replace_dates(make.bronze(row(1, days[1])), name, days[1:2])
    assert rows(spark.table(name).where("booked_date = DATE'2024-01-02'"), ID) == [("t1",)]


def test_a_hot_bucket_is_not_relied_on(spark, make, tmp_path, monkeypatch):
    hot, cold = "default.hot_b", "default.cold_b"
    for name in (hot, cold):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    layer = lambda expr: spark.range(30_000).selectExpr(
        f"{expr} AS transaction_id", "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS booked_at",
        "CAST(rand(1) * 1000 AS DECIMAL(18,2)) AS amount", "'fee' AS transaction_type", "DATE'2024-01-01' AS booked_date",
    )
    write_bucketed(layer("concat('T', if(id % 2 = 0, 0, id))"), hot, str(tmp_path / "hot"), 16)
    write_bucketed(layer("concat('T', id)"), cold, str(tmp_path / "cold"), 16)
    assert is_balanced(spark, hot)  # small buckets are always fine
    monkeypatch.setattr(buckets, "ALWAYS_FINE", 0)
    monkeypatch.setattr(buckets, "MOST_TIMES_MEAN", 1.5)
    assert not is_balanced(spark, hot) and is_balanced(spark, cold)
    by_id = lambda names: plan(read_colocated(spark, *names)[0].groupBy(ID).count())
    assert "Exchange" in by_id([hot, cold]) and "Exchange" not in by_id([cold])
    a, b = read_colocated(spark, hot, cold)
    assert a.join(b, ID).count() == 15_000 * 1 + 15_000


def test_empty_layers(spark, make, tmp_path):
    name = "default.empty_b"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    write_bucketed(make.bronze(), name, str(tmp_path / "e"), 4)
    (empty,) = read_colocated(spark, name)
    assert empty.count() == 0
