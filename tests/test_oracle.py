"""Every registered query equals its DuckDB statement on the sample layers."""

import pytest

import __spark_entry__ as spark_entry
from checks import registry
from checks.compare import difference


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_equals_statement(name, spark, sf_dir, duck):
    assert difference(name, spark_entry.queries()[name](spark, sf_dir), duck) is None


def test_every_query_has_a_statement():
    assert set(registry.QUERIES) <= set(spark_entry.queries())
    assert set(registry.QUERIES) <= set(spark_entry.oracle_sql())


def test_entry(spark):
    assert spark_entry.entry(spark).count() == 146


# Sizes of the sample layers and of some results per scale, see FIXTURES.md.
EXPECTED = {
    "silver_flagged": 15,
    "bronze_duplicates": 6,
    "recon_missing_in_silver": 43,
    "recon_amount_discrepancy": 8,
    "recon_type_mismatch": 5,
    "recon_dates_bronze_not_silver": 1,
    "recon_dates_silver_not_gold": 1,
    "silver_top3_per_day": 90,
}


@pytest.mark.parametrize("name", list(EXPECTED))
def test_planted_faults_are_found(name, spark):
    assert registry.run(name, spark, "/root/testdata/sf0.001").count() == EXPECTED[name]


# Sort keys of queries that promise an order; a minus sign means descending.
ORDERED = {
    "bronze_volume_by_day": ["booked_date"],
    "bronze_type_distribution": ["-txn_count", "transaction_type"],
    "bronze_duplicates": ["-occurrences", "transaction_id"],
    "silver_type_breakdown": ["-txn_count", "transaction_type"],
    "gold_by_type": ["-grand_total", "transaction_type"],
    "gold_cumulative": ["transaction_type", "booked_date"],
    "silver_daily_totals": ["booked_date", "transaction_type"],
    "silver_top3_per_day": ["booked_date", "rnk", "transaction_id"],
    "lifetime_balance": ["-lifetime_net", "transaction_type"],
    "recon_silver_gold": ["booked_date", "transaction_type"],
    "freshness": ["layer"],
}


@pytest.mark.parametrize("name", list(ORDERED))
def test_rows_come_in_order(name, spark, sf_dir):
    got = registry.run(name, spark, sf_dir).collect()

    def place(row):
        out = []
        for key in ORDERED[name]:
            value = row[key.lstrip("-")]
            # NULL comes last in either direction.
            out.append((value is None, -value if key[0] == "-" and value is not None else value or ""))
        return out

    assert len(got) > 1 and [place(r) for r in got] == sorted(place(r) for r in got)
