"""Column expressions shared by the operators. All stay inside whole-stage codegen."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(value: Column, digits: int = 2) -> Column:
    """Round half up. Exact when amounts are DECIMAL, which is what the layer schemas use."""
    return F.round(value, digits)


def ratio(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """Quotient of decimals with up to two digits, rounded half up once; NULL if divided by zero.

    A decimal quotient is itself cut to some digits, and rounding that a second time can go the wrong
    way. Here whole hundredths are divided as whole numbers, so every digit counts.
    """
    whole = "decimal(32,0)"
    top = (numerator * 100).cast(whole)
    bottom = F.nullif((denominator * 100).cast(whole), F.lit(0))
    doubled = F.abs(top) * (2 * 10**digits) + F.abs(bottom)
    size = F.call_function("div", doubled, F.abs(bottom) * 2).cast("decimal(19,0)")
    unit = F.lit(Decimal(1).scaleb(-digits))
    return (F.signum(top).cast("int") * F.signum(bottom).cast("int") * size * unit).cast(
        f"decimal(20,{digits})"
    )


def mean(name: str) -> Column:
    """Average of the non-NULL values, rounded half up once to cents."""
    return ratio(F.sum(name), F.count(name))


def inflow(amount: str) -> Column:
    return F.sum(F.when(F.col(amount) > 0, F.col(amount)).otherwise(0))


def outflow(amount: str) -> Column:
    """Sum of the negative amounts; zero or below."""
    return F.sum(F.when(F.col(amount) < 0, F.col(amount)).otherwise(0))


def week_start(date: str) -> Column:
    """Monday of the week."""
    return F.date_trunc("week", F.col(date)).cast("date")


def asc(*names: str) -> list[Column]:
    """Ascending keys with NULL last (Spark puts NULL first by default)."""
    return [F.col(n).asc_nulls_last() for n in names]


def desc(name: str) -> Column:
    return F.col(name).desc_nulls_last()
