"""What the plans over stored layers must show."""

import re

import pytest

from ledgerstrata.operators import analytics, audits, reconcile
from ledgerstrata.plans import jobs
from ledgerstrata.sources import schemas
from ledgerstrata.plans.quality import quality_report
from ledgerstrata.sources.layers import layer_dates, layer_files, read_layer, stored_files

from .conftest import rows


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def read_columns(text: str) -> list[set[str]]:
    """Columns that each scan takes from the files."""
    return [
        {c.split(":")[0] for c in schema.split(",") if c}
        for schema in re.findall(r"ReadSchema: struct<([^>]*)>", re.sub(r"\(\d+,\d+\)", "", text))
    ]


def test_only_used_columns_are_read(stored):
    assert read_columns(plan(audits.bronze_volume_by_day(stored.bronze))) == [set()]
    assert read_columns(plan(analytics.silver_daily_totals(stored.silver))) == [
        {"amount", "transaction_type", "amount_valid"}
    ]
    freshness = reconcile.freshness(stored.bronze, stored.silver, stored.gold)
    assert read_columns(plan(freshness)) == [set()] * 3


def test_filters_reach_the_scan(stored):
    assert "EqualTo(amount_valid,true)" in plan(analytics.silver_weekly(stored.silver))
    assert "IsNotNull(booked_at)" in plan(jobs.clean_silver(stored.bronze))


def test_dates_prune_partitions(spark, stored):
    some = read_layer(spark, stored.paths.bronze, schemas.BRONZE, ["2024-01-02", "2024-01-03"])
    assert re.search(r"PartitionFilters: \[[^\]]*booked_date[^\]]*2024-01-02", plan(some))
    assert {day for _, day in rows(layer_files(some))} == {"2024-01-02", "2024-01-03"}


def test_aggregates_are_partial_first(stored):
    text = plan(analytics.lifetime_balance(stored.silver))
    assert "partial_sum" in text and "partial_count" in text


def test_one_shuffle_per_aggregate_besides_the_final_sort(stored):
    text = plan(analytics.silver_daily_totals(stored.silver))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("Exchange") == 2


@pytest.mark.parametrize(
    "operator, join",
    [
        (reconcile.recon_missing_in_silver, "LeftAnti"),
        (reconcile.recon_amount_discrepancy, "Inner"),
        (reconcile.silver_coverage, "LeftOuter"),
        (reconcile.recon_layer_counts, "LeftOuter"),
    ],
)
def test_joins_by_id(operator, join, stored):
    text = plan(operator(stored.bronze, stored.silver))
    assert join in text
    assert "Cartesian" not in text and "NestedLoop" not in text


def test_date_gaps_use_the_null_aware_join(stored):
    text = plan(reconcile.recon_dates_bronze_not_silver(stored.bronze, stored.silver))
    assert re.search(r"LeftAnti, BuildRight, true", text)


def test_group_limits_apply_before_the_shuffle(stored):
    for df in (analytics.silver_top3_per_day(stored.silver), jobs.clean_silver(stored.bronze)):
        limits = re.findall(r"WindowGroupLimit .*(Partial|Final)", plan(df))
        assert set(limits) == {"Partial", "Final"}


def test_samples_keep_only_the_first_rows(stored):
    assert "TakeOrderedAndProject" in plan(audits.bronze_sample(stored.bronze))


def test_windows_without_partition_come_after_aggregation(stored):
    for operator in (analytics.silver_running_balance, analytics.silver_day_over_day):
        text = plan(operator(stored.silver))
        assert text.index("Window [") < text.index("HashAggregate")


def test_listings_open_no_parquet_file(spark, stored):
    paths = stored.paths
    dates = [layer_dates(spark, p) for p in (paths.bronze, paths.silver, paths.gold)]
    for df in (
        stored_files(spark, paths.bronze),
        reconcile.freshness(*dates),
        reconcile.recon_dates_bronze_not_silver(*dates[:2]),
        reconcile.recon_dates_silver_not_gold(*dates[1:]),
    ):
        text = plan(df)
        assert "Scan binaryFile" in text.replace("FileScan binaryFile", "Scan binaryFile")
        assert "parquet [" not in text and "ReadSchema: struct<content" not in text
    assert rows(reconcile.freshness(*dates)) == rows(
        reconcile.freshness(stored.bronze, stored.silver, stored.gold)
    )
    assert rows(reconcile.recon_dates_bronze_not_silver(*dates[:2])) == [("2024-01-20",)]
    listed = rows(stored_files(spark, paths.bronze), "booked_date").__len__()
    assert listed == layer_files(stored.bronze).count()


def test_no_broadcast_is_forced(stored):
    for df in (
        analytics.silver_top3_per_day(stored.silver),
        reconcile.medallion_journey(stored.bronze, stored.silver),
        reconcile.recon_missing_in_silver(stored.bronze, stored.silver),
        jobs.rejected_rows(stored.bronze),
    ):
        assert "ResolvedHint" not in df._jdf.queryExecution().analyzed().toString()


def test_quality_report_reads_each_layer_few_times(stored):
    text = plan(quality_report(stored.bronze, stored.silver, stored.gold))
    scans = [len(re.findall(rf"FileScan parquet \[[^\]]*\][^\n]*{name}_transactions", text)) for name in ("bronze", "silver")]
    assert scans == [2, 3]


def test_rejects_share_one_count_of_complete_rows(stored):
    df = jobs.rejected_rows(stored.bronze)
    df.collect()
    assert "ReusedExchange" in plan(df)
