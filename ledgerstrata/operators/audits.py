"""Samples, volumes and data-quality audits of single layers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerstrata.columns import DEFAULT, Columns
from ledgerstrata.functions.exprs import asc, desc, inflow, mean, money, outflow


def _first_rows(df: DataFrame, c: Columns, n: int) -> DataFrame:
    # The other columns make the choice of rows unique; Spark keeps only n rows per task.
    rest = [name for name in df.columns if name not in (c.booked_at, c.id)]
    return df.orderBy(*asc(c.booked_at, c.id, *rest)).limit(n)


def bronze_sample(bronze: DataFrame, c: Columns = DEFAULT, n: int = 20) -> DataFrame:
    return _first_rows(bronze, c, n)


def bronze_volume_by_day(bronze: DataFrame, c: Columns = DEFAULT) -> DataFrame:
    return bronze.groupBy(c.date).agg(F.count("*").alias("row_count")).orderBy(*asc(c.date))


def bronze_type_distribution(bronze: DataFrame, c: Columns = DEFAULT) -> DataFrame:
    return (
        bronze.groupBy(c.type)
        .agg(
            F.count("*").alias("txn_count"),
            money(F.sum(c.amount)).alias("total_amount"),
            mean(c.amount).alias("avg_amount"),
            money(F.min(c.amount)).alias("min_amount"),
            money(F.max(c.amount)).alias("max_amount"),
        )
        .orderBy(desc("txn_count"), *asc(c.type))
    )


def bronze_null_audit(bronze: DataFrame, c: Columns = DEFAULT) -> DataFrame:
    """One row. The distinct count is reduced per task, then by id, before the last step."""
    return bronze.agg(
        F.count("*").alias("total_rows"),
        F.count_if(F.col(c.id).isNull()).alias("null_txn_id"),
        F.count_if(F.col(c.booked_at).isNull()).alias("null_booked_at"),
        F.count_if(F.col(c.amount).isNull()).alias("null_amount"),
        F.count_if(F.col(c.type).isNull()).alias("null_txn_type"),
        F.count_distinct(c.id).alias("distinct_txn_ids"),
    )


def bronze_duplicates(bronze: DataFrame, c: Columns = DEFAULT) -> DataFrame:
    """Ids seen more than once. Rows without id count as one group."""
    return (
        bronze.groupBy(c.id)
        .agg(F.count("*").alias("occurrences"))
        .where("occurrences > 1")
        .orderBy(desc("occurrences"), *asc(c.id))
    )


def bronze_cash_flow(bronze: DataFrame, c: Columns = DEFAULT) -> DataFrame:
    return (
        bronze.groupBy(c.date)
        .agg(
            money(inflow(c.amount)).alias("total_inflows"),
            money(outflow(c.amount)).alias("total_outflows"),
            money(F.sum(c.amount)).alias("net_flow"),
            F.count("*").alias("txn_count"),
        )
        .orderBy(*asc(c.date))
    )


def silver_sample(silver: DataFrame, c: Columns = DEFAULT, n: int = 20) -> DataFrame:
    return _first_rows(silver, c, n)


def silver_validity_by_day(silver: DataFrame, c: Columns = DEFAULT) -> DataFrame:
    return (
        silver.groupBy(c.date)
        .agg(
            F.count("*").alias("row_count"),
            F.count_if(F.col(c.valid)).alias("valid_amount_count"),
            F.count_if(~F.col(c.valid)).alias("invalid_amount_count"),
        )
        .orderBy(*asc(c.date))
    )


def silver_type_breakdown(silver: DataFrame, c: Columns = DEFAULT) -> DataFrame:
    return (
        silver.where(F.col(c.valid))
        .groupBy(c.type)
        .agg(
            F.count("*").alias("txn_count"),
            money(F.sum(c.amount)).alias("total_amount"),
            mean(c.amount).alias("avg_amount"),
        )
        .orderBy(desc("txn_count"), *asc(c.type))
    )


def silver_flagged(silver: DataFrame, c: Columns = DEFAULT) -> DataFrame:
    """Rows with an invalid amount, by date.

    The id as second sort key lets the range partitioning split a date that holds many rows.
    """
    return silver.where(~F.col(c.valid)).orderBy(*asc(c.date, c.id))


def gold_sample(gold: DataFrame, c: Columns = DEFAULT, n: int = 20) -> DataFrame:
    return gold.orderBy(*asc(c.date, c.type, c.total, c.count)).limit(n)
