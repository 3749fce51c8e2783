"""Distinct counts by bitmaps against COUNT(DISTINCT), and what a second run reads."""

import pytest
from pyspark.sql import functions as F

from ledgerstrata.operators import reconcile
from ledgerstrata.plans.distinct import (
    distinct_ids, layer_counts_by_bitmaps, read_bitmaps, store_bitmaps,
)

from .conftest import rows
from .test_plans import plan


@pytest.fixture(scope="module")
def maps(spark, stored, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("bitmaps"))
    store_bitmaps(stored.bronze, f"{root}/b", f"{root}/ids")
    store_bitmaps(stored.silver, f"{root}/s", f"{root}/ids")
    return root


def test_each_id_has_one_number(spark, stored, maps):
    ids = spark.read.parquet(f"{maps}/ids")
    want = stored.bronze.select("transaction_id").where("transaction_id IS NOT NULL").distinct()
    assert ids.count() == want.count() == ids.select("number").distinct().count()
    assert sorted(rows(ids, "transaction_id")) == sorted(rows(want))
    assert ids.agg(F.min("number")).first()[0] == 1


@pytest.mark.parametrize("dates", [None, ["2024-01-02"], ["2024-01-02", "2024-01-03", "2024-01-20"], ["2030-01-01"]])
def test_counts_of_any_span(spark, stored, maps, dates):
    got = distinct_ids(read_bitmaps(spark, f"{maps}/b", dates=dates)).first()[0]
    some = stored.bronze if dates is None else stored.bronze.where(F.col("booked_date").isin(*dates))
    assert got == some.agg(F.count_distinct("transaction_id")).first()[0]


def test_layer_counts_read_no_id(spark, stored, maps):
    df = layer_counts_by_bitmaps(read_bitmaps(spark, f"{maps}/b"), read_bitmaps(spark, f"{maps}/s"))
    want = reconcile.recon_layer_counts(stored.bronze, stored.silver)
    assert df.columns == want.columns and rows(df) == rows(want)
    assert "transaction_id" not in plan(df)


def test_dates_are_renewed_and_known_ids_keep_their_numbers(spark, make, tmp_path):
    row = lambda i, day: (i, f"{day} 08:00:00", "1.00", "fee", day)
    a, b = "2024-01-01", "2024-01-02"
    path, ids = f"{tmp_path}/b", f"{tmp_path}/ids"
    numbers = lambda: dict(rows(spark.read.parquet(ids)))
    count = lambda *dates: distinct_ids(read_bitmaps(spark, path, dates=dates or None)).first()[0]
    store_bitmaps(make.bronze(row("x", a), row("y", a), row("y", b), row(None, b), ("u", None, "1.00", "fee", None)), path, ids)
    before = numbers()
    assert (count(), count(a), count(b)) == (3, 2, 1)
    store_bitmaps(make.bronze(row("x", b), row("z", b), row("w", b)), path, ids, dates=[b])
    after = numbers()
    assert {k: after[k] for k in before} == before and set(after) == {"x", "y", "u", "z", "w"}
    assert len(set(after.values())) == 5
    assert (count(), count(a), count(b)) == (5, 2, 3)
    store_bitmaps(make.bronze(), path, ids, dates=[b])
    assert (count(), count(b)) == (3, 0)
    # A date whose rows have no id is there, with nothing in it.
    store_bitmaps(make.bronze(row(None, b)), path, ids, dates=[b])
    by_date = dict(rows(distinct_ids(read_bitmaps(spark, path), F.col("booked_date"))))
    assert by_date == {a: 2, b: 0, None: 1}


def test_bitmaps_are_dense(spark, tmp_path):
    """A date's new ids lie in few bitmaps, as they are numbered date by date."""
    layer = spark.range(400_000).selectExpr(
        "concat('T', xxhash64(id)) AS transaction_id", "date_add(DATE'2024-01-01', CAST(id % 4 AS INT)) AS booked_date"
    )
    store_bitmaps(layer, f"{tmp_path}/b", f"{tmp_path}/ids")
    maps = read_bitmaps(spark, f"{tmp_path}/b")
    # 100,000 ids of a date need four bitmaps; each of the eight tasks may begin and end one.
    assert maps.count() <= 4 * 4 + 2 * 8 + 4
    assert distinct_ids(maps).first()[0] == 400_000
