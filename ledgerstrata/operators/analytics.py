"""Totals, balances, rankings and pivots over Silver and Gold.

Window functions without a partition key run over one row per date, after aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerstrata.columns import DEFAULT, Columns
from ledgerstrata.functions.exprs import asc, desc, inflow, money, outflow, ratio, week_start
from ledgerstrata.sources.schemas import TRANSACTION_TYPES


def _valid(silver: DataFrame, c: Columns) -> DataFrame:
    return silver.where(F.col(c.valid))


def _until_now(window):
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def silver_running_balance(silver: DataFrame, c: Columns = DEFAULT) -> DataFrame:
    daily = _valid(silver, c).groupBy(c.date).agg(F.sum(c.amount).alias("_net"))
    by_date = _until_now(Window.orderBy(*asc(c.date)))
    return daily.select(
        c.date,
        money(F.col("_net")).alias("daily_net"),
        money(F.sum("_net").over(by_date)).alias("running_balance"),
    ).orderBy(*asc(c.date))


def daily_totals(silver: DataFrame, c: Columns = DEFAULT) -> DataFrame:
    """Total and count of valid rows per date and type: the rule that Gold stores."""
    return (
        _valid(silver, c)
        .groupBy(c.date, c.type)
        .agg(money(F.sum(c.amount)).alias(c.total), F.count("*").alias(c.count))
    )


def silver_daily_totals(silver: DataFrame, c: Columns = DEFAULT) -> DataFrame:
    """Gold recomputed from Silver."""
    return daily_totals(silver, c).orderBy(*asc(c.date, c.type))


def silver_weekly(silver: DataFrame, c: Columns = DEFAULT) -> DataFrame:
    return (
        _valid(silver, c)
        .groupBy(week_start(c.date).alias("week_start"), c.type)
        .agg(money(F.sum(c.amount)).alias("weekly_net"), F.count("*").alias("txn_count"))
        .orderBy(*asc("week_start", c.type))
    )


def silver_top3_per_day(silver: DataFrame, c: Columns = DEFAULT, k: int = 3) -> DataFrame:
    """Rows of each date whose rank by absolute amount is at most ``k``; ties share a rank.

    The k largest values per date are found first, with at most k rows per date leaving each task.
    The rank of a row is one more than the number of those values above it, so every tied row is
    ranked where it was read, however many there are.
    """
    valid = _valid(silver, c).select(c.date, c.id, c.type, c.amount)
    size = F.abs(F.col(c.amount))
    by_size = Window.partitionBy(c.date).orderBy(size.desc_nulls_last())
    largest = (
        valid.select(F.col(c.date).alias("_date"), F.col(c.date), F.col(c.amount))
        .withColumn("_place", F.row_number().over(by_size))
        .where(F.col("_place") <= k)
        .groupBy("_date")
        .agg(
            F.collect_list(size).alias("_largest"),
            F.when(F.count(size) == k, F.min(size)).alias("_least"),
        )
    )
    # Without k known amounts on a date, every row of it is in.
    enough = F.col("_least").isNull() | (size >= F.col("_least"))
    above = F.size(F.filter("_largest", lambda x: F.col(c.amount).isNull() | (x > size)))
    same_date = F.col(c.date).eqNullSafe(F.col("_date"))
    return (
        valid.join(largest, same_date & enough)
        .withColumn("rnk", (above + 1).cast("bigint"))
        .select(c.date, c.id, c.type, c.amount, "rnk")
        .orderBy(*asc(c.date, "rnk", c.id))
    )


def silver_liquidity_ratio(silver: DataFrame, c: Columns = DEFAULT) -> DataFrame:
    """Deposits against withdrawals per date; no ratio on a date without withdrawals."""
    daily = (
        _valid(silver, c)
        .groupBy(c.date)
        .agg(inflow(c.amount).alias("_in"), F.abs(outflow(c.amount)).alias("_out"))
    )
    return daily.select(
        c.date,
        money(F.col("_in")).alias("deposits"),
        money(F.col("_out")).alias("withdrawals"),
        ratio(F.col("_in"), F.col("_out")).alias("deposit_withdrawal_ratio"),
    ).orderBy(*asc(c.date))


def silver_day_over_day(silver: DataFrame, c: Columns = DEFAULT) -> DataFrame:
    """Net per date and its change from the previous date that has rows."""
    daily = _valid(silver, c).groupBy(c.date).agg(F.sum(c.amount).alias("_net"))
    previous = F.lag("_net").over(Window.orderBy(*asc(c.date)))
    return daily.select(
        c.date,
        money(F.col("_net")).alias("daily_net"),
        money(F.col("_net") - previous).alias("day_over_day_delta"),
    ).orderBy(*asc(c.date))


def lifetime_balance(silver: DataFrame, c: Columns = DEFAULT) -> DataFrame:
    return (
        _valid(silver, c)
        .groupBy(c.type)
        .agg(
            money(F.sum(c.amount)).alias("lifetime_net"),
            F.count("*").alias("total_txn_count"),
            F.min(c.date).alias("first_txn_date"),
            F.max(c.date).alias("last_txn_date"),
        )
        .orderBy(desc("lifetime_net"), *asc(c.type))
    )


def daily_pivot(
    silver: DataFrame, c: Columns = DEFAULT, types: Sequence[str] = tuple(TRANSACTION_TYPES)
) -> DataFrame:
    """One column per listed type, NULL where a date has none, and the total over all types.

    One aggregation gives both; with a fixed list no extra job looks for the types.
    """
    return (
        _valid(silver, c)
        .groupBy(c.date)
        .agg(
            *[money(F.sum(F.when(F.col(c.type) == t, F.col(c.amount)))).alias(t) for t in types],
            money(F.sum(c.amount)).alias("total"),
        )
        .orderBy(*asc(c.date))
    )


def gold_by_day(gold: DataFrame, c: Columns = DEFAULT) -> DataFrame:
    return (
        gold.groupBy(c.date)
        .agg(
            F.count("*").alias("type_count"),
            money(F.sum(c.total)).alias("total_amount"),
            F.sum(c.count).alias("total_records"),
        )
        .orderBy(*asc(c.date))
    )


def gold_by_type(gold: DataFrame, c: Columns = DEFAULT) -> DataFrame:
    return (
        gold.groupBy(c.type)
        .agg(
            money(F.sum(c.total)).alias("grand_total"),
            F.sum(c.count).alias("total_records"),
            F.count_distinct(c.date).alias("days_present"),
        )
        .orderBy(desc("grand_total"), *asc(c.type))
    )


def gold_cumulative(gold: DataFrame, c: Columns = DEFAULT) -> DataFrame:
    """Running total per type. A type has one Gold row per date, so its window stays small."""
    per_type = _until_now(Window.partitionBy(c.type).orderBy(*asc(c.date)))
    return gold.select(
        c.date, c.type, c.total, money(F.sum(c.total).over(per_type)).alias("cumulative_total")
    ).orderBy(*asc(c.type, c.date))


def gold_weekly(gold: DataFrame, c: Columns = DEFAULT) -> DataFrame:
    return (
        gold.groupBy(week_start(c.date).alias("week_start"), c.type)
        .agg(
            money(F.sum(c.total)).alias("weekly_total"), F.sum(c.count).alias("weekly_records")
        )
        .orderBy(*asc("week_start", c.type))
    )
