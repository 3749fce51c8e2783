"""Layers derived from the ``events`` table, with the faults that ``FIXTURES.md`` plants.

Every remainder test below chooses rows to damage or repeat. Dates are missing in ``silver`` and ``gold``
only, which serve the queries that look for missing dates and rows; queries on one layer take
``bronze``, ``silver_clean`` or ``gold_clean``, which have all rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ledgerstrata.plans.jobs import build_gold, clean_silver

# Transaction type of each event type.
TYPE_OF_EVENT = {
    "signup": "deposit",
    "click": "withdrawal",
    "purchase": "payment",
    "view": "transfer",
    "error": "fee",
}


@dataclass(frozen=True)
class SampleLayers:
    spark: SparkSession
    sf_dir: str

    @cached_property
    def _events(self) -> DataFrame:
        """Events with their transaction type; chosen ones come twice."""
        kinds = " ".join(f"WHEN '{event}' THEN '{kind}'" for event, kind in TYPE_OF_EVENT.items())
        return self.spark.read.parquet(f"{self.sf_dir}/events.parquet").selectExpr(
            "event_id AS e",
            "ts",
            f"CASE event_type {kinds} END AS kind",
            "CAST(value AS DECIMAL(18,2)) AS v",
            "explode(IF(event_id % 197 = 29, array(1, 2), array(1))) AS copy",
        )

    @cached_property
    def bronze(self) -> DataFrame:
        amount = """
            CASE WHEN e % 229 = 23 THEN NULL
                 WHEN e % 233 = 31 THEN 0
                 WHEN e % 239 = 37 THEN 9999999.99
                 WHEN kind = 'deposit' OR (kind = 'transfer' AND e % 2 = 0) THEN v
                 ELSE -v END"""
        return self._events.selectExpr(
            "IF(e % 211 = 13, NULL, concat('T', lpad(CAST(e AS STRING), 10, '0'))) AS transaction_id",
            "IF(e % 223 = 17, NULL, ts) AS booked_at",
            f"CAST({amount} AS DECIMAL(18,2)) AS amount",
            "CASE WHEN e % 227 = 19 THEN NULL WHEN e % 53 = 5 THEN upper(kind) ELSE kind END"
            " AS transaction_type",
            "CAST(ts AS DATE) AS booked_date",
        )

    @cached_property
    def raw(self) -> DataFrame:
        """Bronze as text, before typing: blank ids, and amounts that are no numbers."""
        return self.bronze.selectExpr(
            "coalesce(transaction_id, ' ') AS transaction_id",
            "CAST(booked_at AS STRING) AS booked_at",
            "coalesce(CAST(amount AS STRING), 'n/a') AS amount",
            "transaction_type",
            "CAST(booked_date AS STRING) AS booked_date",
        )

    @cached_property
    def silver_clean(self) -> DataFrame:
        return clean_silver(self.bronze)

    @cached_property
    def gold_clean(self) -> DataFrame:
        return build_gold(self.silver_clean)

    @cached_property
    def silver(self) -> DataFrame:
        """Silver with a missing date, shifted amounts and lost amounts."""
        number = "CAST(substr(transaction_id, 2) AS BIGINT)"
        amount = f"""
            CASE WHEN {number} % 251 = 43 THEN NULL
                 WHEN {number} % 241 = 41 THEN amount + 0.01
                 ELSE amount END"""
        return self.silver_clean.where("booked_date <> DATE '2024-01-20'").selectExpr(
            "transaction_id",
            "booked_at",
            f"CAST({amount} AS DECIMAL(18,2)) AS amount",
            "transaction_type",
            "amount_valid",
            "booked_date",
        )

    @cached_property
    def gold(self) -> DataFrame:
        """Gold with two missing dates, one wrong total and one row that Silver does not have."""
        wrong = "booked_date = DATE '2024-01-05' AND transaction_type = 'deposit'"
        damaged = self.gold_clean.where(
            "booked_date NOT IN (DATE '2024-01-10', DATE '2024-01-20')"
        ).selectExpr(
            "transaction_type",
            f"CAST(daily_total + IF({wrong}, 1, 0) AS DECIMAL(18,2)) AS daily_total",
            "record_count",
            "booked_date",
        )
        extra = self.spark.range(1).selectExpr(
            "'deposit'", "CAST(100 AS DECIMAL(18,2))", "CAST(1 AS BIGINT)", "DATE '2024-02-01'"
        )
        return damaged.union(extra)
