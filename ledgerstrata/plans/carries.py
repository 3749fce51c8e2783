"""Running totals that a correction renews from its month on, without a window over all dates.

Sums run in two levels: within each month, by windows that are one month long, and over months, where one
total per month and key is carried forward. Rows keep what ran within their month; what came before
them is a carry per month and key. So a corrected date rewrites the rows of its month and the carries of
later months, and no row of any other month.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerstrata.columns import DEFAULT, Columns
from ledgerstrata.functions.exprs import asc, money
from ledgerstrata.sources.layers import read_layer, write_layer

# Months stand where dates do in the layout of a layer.
_MONTHS = Columns(date="month")
_SUM = "decimal(38,2)"


def daily_net(silver: DataFrame, c: Columns = DEFAULT) -> DataFrame:
    """Net of the valid rows per date, as ``value``."""
    return silver.where(F.col(c.valid)).groupBy(c.date).agg(F.sum(c.amount).cast(_SUM).alias("value"))


def daily_gold(gold: DataFrame, c: Columns = DEFAULT) -> DataFrame:
    """Totals of Gold per date and type, as ``value``."""
    return gold.select(c.date, c.type, F.col(c.total).cast(_SUM).alias("value"))


def store_running(
    values: DataFrame, path: str, by: Sequence[str] = (), dates: Iterable[date | str] | None = None,
    c: Columns = DEFAULT,
) -> None:
    """Store the running totals of ``value`` per date, for each key ``by``; or renew the months of ``dates``.

    ``values`` has one row per date and key. A renewed month is taken from ``values`` as a whole; a month
    that has no rows any more is emptied. Rows without date are left out.
    """
    spark = values.sparkSession
    months = None if dates is None else sorted({f"{str(d)[:7]}-01" for d in dates})
    rows = values.where(F.col(c.date).isNotNull()).withColumn("month", F.trunc(c.date, "month"))
    if months is not None:
        rows = rows.where(F.col("month").isin([F.lit(m).cast("date") for m in months]))
    in_month = Window.partitionBy("month", *by).orderBy(c.date)
    local = rows.select(
        *by, c.date, "value",
        F.sum("value").over(in_month.rowsBetween(Window.unboundedPreceding, 0)).cast(_SUM).alias("running"),
        F.lag("value").over(in_month).alias("previous"),
        (F.row_number().over(in_month) == 1).alias("opens"),
        "month",
    )
    write_layer(local, f"{path}/rows", _MONTHS, dates=months, clear=True)
    stored = read_layer(spark, f"{path}/rows", local.schema, months, _MONTHS)
    totals = stored.groupBy("month", *by).agg(
        F.sum("value").cast(_SUM).alias("total"), F.max_by("value", c.date).alias("last")
    )
    write_layer(totals, f"{path}/totals", _MONTHS, dates=months, clear=True)
    carried = _carried(read_layer(spark, f"{path}/totals", totals.schema, c=_MONTHS), by)
    if months is None:
        write_layer(carried, f"{path}/carries", _MONTHS, clear=True)
        return
    # Also months that are emptied: what came after them starts from less.
    later = carried.where(F.col("month") >= F.lit(months[0]).cast("date"))
    write_layer(later, f"{path}/carries", _MONTHS, dates=months, clear=True)


def _carried(totals: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sum of all earlier months and their last value, for each month and key.

    The months of a key are one array, as long as the calendar; no window goes over them.
    """
    own = F.sort_array(F.collect_list(F.struct("month", "total", "last")))
    listed = totals.groupBy(*by).agg(own.alias("own"))
    zero = F.lit(0).cast(_SUM)
    before = F.slice("own", F.lit(1), F.col("i"))
    carry = F.aggregate(before, zero, lambda s, m: (s + F.coalesce(m["total"], zero)).cast(_SUM))
    return (
        listed.select(*by, "own", F.posexplode("own").alias("i", "m"))
        .select(*by, carry.alias("carry"), F.get("own", F.col("i") - 1)["last"].alias("last"), F.col("m.month").alias("month"))
    )


def read_running(
    spark: SparkSession, path: str, by: Sequence[str] = (), dates: Iterable[date | str] | None = None,
    c: Columns = DEFAULT,
) -> DataFrame:
    """Date, keys, ``value``, ``running`` (total up to the date) and ``previous`` (value of the date before).

    With ``dates`` only their months are read.
    """
    dates = None if dates is None else [str(d) for d in dates]
    months = None if dates is None else sorted({f"{d[:7]}-01" for d in dates})
    rows = read_layer(spark, f"{path}/rows", dates=months, c=_MONTHS).alias("r")
    if dates is not None:
        rows = rows.where(F.col(c.date).isin([F.lit(d).cast("date") for d in dates]))
    carries = read_layer(spark, f"{path}/carries", dates=months, c=_MONTHS).alias("k")
    same: list[Column] = [F.col(f"r.{n}").eqNullSafe(F.col(f"k.{n}")) for n in ("month", *by)]
    previous = F.when(F.col("opens"), F.col("last")).otherwise(F.col("previous"))
    return rows.join(carries, same).select(
        *[F.col(f"r.{n}") for n in (c.date, *by, "value")],
        (F.col("carry") + F.col("running")).alias("running"),
        previous.alias("previous"),
    )


def running_balance(running: DataFrame, c: Columns = DEFAULT) -> DataFrame:
    """As ``silver_running_balance``, from stored running totals of ``daily_net``."""
    shown = money(F.col("value")).alias("daily_net"), money(F.col("running")).alias("running_balance")
    return running.select(c.date, *shown).orderBy(*asc(c.date))


def day_over_day(running: DataFrame, c: Columns = DEFAULT) -> DataFrame:
    """As ``silver_day_over_day``, from stored running totals of ``daily_net``."""
    delta = money(F.col("value") - F.col("previous")).alias("day_over_day_delta")
    return running.select(c.date, money(F.col("value")).alias("daily_net"), delta).orderBy(*asc(c.date))


def cumulative(running: DataFrame, c: Columns = DEFAULT) -> DataFrame:
    """As ``gold_cumulative``, from stored running totals of ``daily_gold`` by type."""
    shown = F.col("value").alias(c.total), money(F.col("running")).alias("cumulative_total")
    return running.select(c.date, c.type, *shown).orderBy(*asc(c.type, c.date))
