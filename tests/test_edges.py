"""Hand-made rows for the cases the sample layers do not hold."""

from dataclasses import fields

import pytest
from pyspark.sql import functions as F

from ledgerstrata import Columns
from ledgerstrata.operators import analytics, audits, reconcile
from ledgerstrata.operators.percentiles import silver_percentiles
from ledgerstrata.plans import jobs
from ledgerstrata.plans.quality import quality_report

from .conftest import rows

DAY, NEXT = "2024-01-01", "2024-01-02"


def silver_row(id_, amount, type_="fee", valid="true", date=DAY):
    return (id_, f"{date} 08:00:00" if date else None, amount, type_, valid, date)


def bronze_row(id_, amount, type_="fee", date=DAY):
    return (id_, f"{date} 08:00:00" if date else None, amount, type_, date)


def test_rank_keeps_ties_across_the_limit(make):
    silver = make.silver(
        silver_row("a", "9.00"),
        silver_row("b", "-8.00"),
        silver_row("c", "8.00"),
        silver_row("d", "8.00"),
        silver_row("e", "7.00"),
        silver_row("f", "99.00", valid="false"),
    )
    got = analytics.silver_top3_per_day(silver)
    assert rows(got, "transaction_id", "rnk") == [("a", 1), ("b", 2), ("c", 2), ("d", 2)]


def test_rank_counts_rows_not_values(make):
    silver = make.silver(
        *[silver_row(f"a{i}", "9.00") for i in range(4)],
        silver_row("b", "8.00"),
        silver_row("c", None, date=NEXT),
        silver_row("d", None, date=NEXT),
        silver_row("e", "1.00", date=NEXT),
        silver_row("f", "1.00", date=None),
    )
    got = analytics.silver_top3_per_day(silver)
    assert rows(got, "booked_date", "transaction_id", "rnk") == [
        (DAY, "a0", 1), (DAY, "a1", 1), (DAY, "a2", 1), (DAY, "a3", 1),
        (NEXT, "e", 1), (NEXT, "c", 2), (NEXT, "d", 2),
        (None, "f", 1),
    ]


def test_not_in_with_null_on_the_right_is_empty(make):
    bronze = make.bronze(bronze_row("a", "1.00"), bronze_row("b", "1.00", date=NEXT))
    silver = make.silver(silver_row("a", "1.00"))
    no_date = make.silver(silver_row("z", "1.00", date=None))
    missing = reconcile.recon_dates_bronze_not_silver
    assert rows(missing(bronze, silver)) == [(NEXT,)]
    assert rows(missing(bronze, silver.union(no_date))) == []
    undated = bronze.union(make.bronze(bronze_row("c", "1.00", date=None)))
    assert rows(missing(undated, silver)) == [(NEXT,)]
    assert rows(missing(undated, silver.limit(0))) == [(DAY,), (NEXT,), (None,)]


def test_ratio_is_null_without_withdrawals(make):
    silver = make.silver(
        silver_row("a", "5.00"), silver_row("b", "2.00", date=NEXT), silver_row("c", "-3.00", date=NEXT)
    )
    assert rows(analytics.silver_liquidity_ratio(silver)) == [
        (DAY, 5.0, 0.0, None),
        (NEXT, 2.0, 3.0, 0.67),
    ]


def test_pivot_totals_unlisted_types(make):
    silver = make.silver(silver_row("a", "5.00", "deposit"), silver_row("b", "2.00", "refund"))
    assert rows(analytics.daily_pivot(silver)) == [(DAY, 5.0, None, None, None, None, 7.0)]


def test_ratio_is_rounded_once(make):
    day = "2024-01-01"
    rows_ = [("a", f"{day} 01:00:00", "499999999.99", "fee", "true", day)]
    rows_ += [("b", f"{day} 01:00:00", "-99999999999.99", "fee", "true", day), ("c", f"{day} 01:00:00", "-0.01", "fee", "true", day)]
    got = analytics.silver_liquidity_ratio(make.silver(*rows_))
    assert rows(got, "deposit_withdrawal_ratio") == [(0.0,)]
    half = [("a", f"{day} 01:00:00", "0.01", "fee", "true", day), ("b", f"{day} 01:00:00", "-2.00", "fee", "true", day)]
    assert rows(analytics.silver_liquidity_ratio(make.silver(*half)), "deposit_withdrawal_ratio") == [(0.01,)]


def test_averages_round_half_up_once(make):
    bronze = make.bronze(
        *[bronze_row(str(i), a) for i, a in enumerate(["0.01", "0.00"])],
        *[bronze_row(str(i), a, "payment") for i, a in enumerate(["-0.01", "0.00"])],
        bronze_row("n", None, "transfer"),
    )
    got = dict(rows(audits.bronze_type_distribution(bronze), "transaction_type", "avg_amount"))
    assert got == {"fee": 0.01, "payment": -0.01, "transfer": None}


def test_day_over_day_uses_the_previous_existing_date(make):
    silver = make.silver(silver_row("a", "5.00"), silver_row("b", "7.50", date="2024-01-09"))
    assert rows(analytics.silver_day_over_day(silver)) == [
        (DAY, 5.0, None),
        ("2024-01-09", 7.5, 2.5),
    ]


def test_repeated_ids_count_once_per_pair(make):
    bronze = make.bronze(*[bronze_row("a", "1.00")] * 3, bronze_row(None, "1.00"))
    silver = make.silver(*[silver_row("a", "2.00", "FEE")] * 2, silver_row(None, "1.00"))
    assert rows(reconcile.matched_by_type(bronze, silver)) == [("fee", 6)]
    assert rows(reconcile.matched_by_type(bronze, silver, where="transaction_type = 'x'")) == []
    assert rows(reconcile.recon_type_mismatch(bronze, silver)) == [("fee", "FEE", 6)]
    assert rows(reconcile.recon_amount_discrepancy(bronze, silver)) == [
        ("a", DAY, 1.0, 2.0, -1.0)
    ] * 6
    assert rows(reconcile.recon_layer_counts(bronze, silver)) == [(DAY, 1, 1, 0)]
    assert rows(reconcile.silver_coverage(bronze, silver)) == [(DAY, 6, 6, 100.0), (None, 0, 0, None)]
    journey = rows(reconcile.medallion_journey(bronze, silver), "transaction_id", "daily_type_total")
    assert journey == [("a", 12.0)] * 6 + [(None, 12.0)]


def test_coverage_by_bronze_date_shows_gaps(make):
    bronze = make.bronze(
        bronze_row("a", "1.00"), bronze_row("b", "1.00"), bronze_row("c", "1.00"),
        bronze_row("d", "1.00", date=NEXT),
    )
    silver = make.silver(silver_row("a", "1.00"), silver_row("d", "1.00", date=DAY))
    assert rows(reconcile.silver_coverage(bronze, silver, by="bronze")) == [
        (DAY, 1, 3, 33.3),
        (NEXT, 0, 1, 0.0),
    ]


def test_journey_with_rows_without_date(make):
    bronze = make.bronze(
        bronze_row("a", "1.00"), bronze_row("b", "2.00", None, None), bronze_row("c", "3.00", None, None)
    )
    silver = make.silver(silver_row("b", "2.00"), silver_row("c", "3.00"))
    got = reconcile.medallion_journey(bronze, silver)
    assert rows(got, "transaction_id", "daily_type_total") == [("a", None), ("b", 5.0), ("c", 5.0)]
    assert rows(reconcile.medallion_journey(bronze, silver, n=2), "transaction_id") == [("a",), ("b",)]


def test_weeks_start_on_monday(make):
    gold = make.gold(("fee", "1.00", 1, "2024-01-07"), ("fee", "2.00", 1, "2024-01-08"))
    assert rows(analytics.gold_weekly(gold), "week_start", "weekly_total") == [
        ("2024-01-01", 1.0),
        ("2024-01-08", 2.0),
    ]


ONE_LAYER = {
    "bronze": [
        audits.bronze_sample, audits.bronze_volume_by_day, audits.bronze_type_distribution,
        audits.bronze_duplicates, audits.bronze_cash_flow, jobs.clean_silver, jobs.rejected_rows,
    ],
    "silver": [
        audits.silver_sample, audits.silver_validity_by_day, audits.silver_type_breakdown,
        audits.silver_flagged, analytics.silver_running_balance, analytics.silver_daily_totals,
        analytics.silver_weekly, analytics.silver_top3_per_day, analytics.silver_liquidity_ratio,
        analytics.silver_day_over_day, analytics.lifetime_balance, analytics.daily_pivot,
        silver_percentiles, jobs.build_gold,
    ],
    "gold": [
        audits.gold_sample, analytics.gold_by_day, analytics.gold_by_type,
        analytics.gold_cumulative, analytics.gold_weekly,
    ],
}
TWO_LAYERS = [
    reconcile.recon_layer_counts, reconcile.recon_missing_in_silver,
    reconcile.recon_amount_discrepancy, reconcile.recon_type_mismatch,
    reconcile.recon_dates_bronze_not_silver, reconcile.silver_coverage,
    reconcile.matched_by_type, reconcile.medallion_journey,
]


@pytest.mark.parametrize(
    "layer, operator", [(name, f) for name, group in ONE_LAYER.items() for f in group]
)
def test_empty_layer(layer, operator, make):
    assert rows(operator(getattr(make, layer)())) == []


@pytest.mark.parametrize("operator", TWO_LAYERS)
def test_empty_layers(operator, make):
    assert rows(operator(make.bronze(), make.silver())) == []
    assert rows(operator(make.bronze(), make.silver(silver_row("a", "1.00")))) == []


def test_empty_silver_rejects_nothing_from_bronze(make):
    bronze = make.bronze(bronze_row("a", "1.00"), bronze_row(None, "1.00"))
    assert reconcile.recon_missing_in_silver(bronze, make.silver()).count() == 2


def test_empty_layers_one_row_results(make):
    bronze, silver, gold = make.bronze(), make.silver(), make.gold()
    assert rows(audits.bronze_null_audit(bronze)) == [(0, 0, 0, 0, 0, 0)]
    assert rows(reconcile.freshness(bronze, silver, gold)) == [
        ("bronze", None), ("gold", None), ("silver", None),
    ]
    assert rows(reconcile.recon_silver_gold(silver, gold)) == []
    assert quality_report(bronze, silver, gold).where("failing <> 0 OR NOT passed").isEmpty()


def test_other_column_names(make, sample):
    c = Columns(**{f.name: f"x_{f.name}" for f in fields(Columns)})

    def renamed(df):
        names = {getattr(Columns(), f.name): getattr(c, f.name) for f in fields(Columns)}
        return df.select(*[F.col(n).alias(names[n]) for n in df.columns])

    bronze, silver, gold = renamed(sample.bronze), renamed(sample.silver), renamed(sample.gold)
    for operator in ONE_LAYER["bronze"]:
        operator(bronze, c).schema
    for operator in ONE_LAYER["silver"]:
        operator(silver, c).schema
    for operator in ONE_LAYER["gold"]:
        operator(gold, c).schema
    for operator in TWO_LAYERS:
        operator(bronze, silver, c).schema
    assert rows(reconcile.recon_silver_gold(silver, gold, c)) == rows(
        reconcile.recon_silver_gold(sample.silver, sample.gold)
    )
    assert quality_report(bronze, silver, gold, c).count() == 19
