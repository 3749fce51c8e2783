"""Key sets and the runtime filters that joins with them get."""

import pytest
from pyspark.sql import functions as F

from ledgerstrata.operators import reconcile
from ledgerstrata.plans.jobs import dates_with_keys
from ledgerstrata.sources.keys import runtime_filter, store_keys
from ledgerstrata.sources.layers import only_dates, read_layer, write_layer
from ledgerstrata.sources import schemas

from .conftest import rows

RUN, ID = ["2024-01-03"], "transaction_id"


@pytest.fixture
def shuffled(spark):
    """Joins that shuffle, as they do at a size where the set is not broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture(scope="module")
def layer(spark, tmp_path_factory):
    """20,000 ids over 20 dates; 10 ids of the run's date come again on two others."""
    path = str(tmp_path_factory.mktemp("keys") / "bronze")
    base = spark.range(20_000).selectExpr(
        "concat('T', id) AS transaction_id", "id % 20 AS day", "id"
    )
    again = spark.range(10).selectExpr("concat('T', 20 * id + 2) AS transaction_id", "10 + id % 2 AS day", "id")
    df = base.union(again).selectExpr(
        "transaction_id", "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS booked_at", "CAST(id AS DECIMAL(18,2)) AS amount",
        "'fee' AS transaction_type", "date_add(DATE'2024-01-01', CAST(day AS INT)) AS booked_date",
    )
    write_layer(df, path)
    return read_layer(spark, path, schemas.BRONZE)


def executed(df):
    return df._jdf.queryExecution().executedPlan()


def passed_by_filters(plan):
    """Rows that filters with a Bloom filter let through, from the metrics of an executed plan."""
    name = plan.nodeName()
    if name.startswith("AdaptiveSparkPlan"):
        return passed_by_filters(plan.executedPlan())
    if "QueryStage" in name:
        return passed_by_filters(plan.plan())
    found = []
    if name == "Filter" and "might_contain" in plan.simpleString(10_000):
        found.append(plan.metrics().apply("numOutputRows").value())
    children = plan.children()
    for i in range(children.size()):
        found += passed_by_filters(children.apply(i))
    return found


def test_foreign_rows_are_dropped_before_the_shuffle(spark, layer, shuffled):
    keys = store_keys(only_dates(layer, RUN), ID)
    assert keys.count == 1000
    others = layer.where("booked_date <> DATE'2024-01-03'")
    df = keys.those_in(others.select(ID, "booked_date"))
    with runtime_filter(spark, keys):
        assert len(df.collect()) == 10
        text = executed(df).toString()
        at = text.index("might_contain")
        assert text.rindex("Exchange hashpartitioning", 0, at) < at < text.index("FileScan", at)
        (passed,) = passed_by_filters(executed(df))
    assert 10 <= passed <= 10 + 0.05 * 19_000


@pytest.mark.parametrize("bits", [64, 2_000, 1_000_000, None])
def test_a_filter_of_any_size_gives_the_same_rows(spark, layer, shuffled, bits):
    keys = store_keys(only_dates(layer, RUN), ID)
    others = layer.where("booked_date <> DATE'2024-01-03'")
    with runtime_filter(spark, keys, bits):
        got = sorted(rows(keys.those_in(others).select(ID, "booked_date")))
    own = only_dates(layer, RUN).select(ID)
    assert got == sorted(rows(others.join(own, ID, "left_semi").select(ID, "booked_date")))


def test_dates_that_share_ids(spark, layer, shuffled):
    keys = store_keys(only_dates(layer, RUN), ID)
    all_dates = [f"2024-01-{d:02d}" for d in range(1, 21)]
    assert dates_with_keys(layer, keys, all_dates) == {*RUN, "2024-01-11", "2024-01-12"}
    nothing = store_keys(layer.where("false"), ID)
    assert dates_with_keys(layer, nothing, all_dates) == set()


def test_settings_come_back(spark, layer):
    name = "spark.sql.optimizer.runtime.bloomFilter.numBits"
    spark.conf.set(name, "4096")
    keys = store_keys(layer.limit(3), ID)
    with pytest.raises(ZeroDivisionError), runtime_filter(spark, keys, 77):
        assert spark.conf.get(name) == "77"
        _ = 1 / 0
    assert spark.conf.get(name) == "4096"
    spark.conf.unset(name)


def test_null_ids_are_in_no_set(spark, make):
    bronze = make.bronze((None, None, "1.00", "fee", "2024-01-01"), ("a", None, "1.00", "fee", "2024-01-01"))
    keys = store_keys(bronze, ID)
    assert keys.count == 1
    with runtime_filter(spark, keys):
        assert rows(keys.those_in(bronze).select(ID)) == [("a",)]


def test_the_journey_shuffles_no_foreign_silver_rows(spark, stored, shuffled):
    df = reconcile.medallion_journey(stored.bronze, stored.silver)
    text = executed(df).toString()
    assert "In(transaction_id" in text  # the ids of the first rows reach the scan of Silver
    assert text.count("silver_transactions") == 1
    assert df.count() == 50
    assert df.where(F.col("daily_type_total").isNotNull()).count() > 0
