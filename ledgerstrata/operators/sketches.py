"""Percentiles that add up: quantile sketches per date and type, merged for any span of dates.

A sketch is Spark's own KLL sketch over whole cents. Merging sketches gives what one sketch over all
rows would, within the promised rank error, so percentiles of a span of dates read no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerstrata.columns import DEFAULT, Columns

SHARES = (0.25, 0.50, 0.75, 0.95)
NAMES = ("p25", "median", "p75", "p95")
# Items of a sketch's first level. Ranks are off by about 2.3 / K^0.9 at most, which is 0.13 % here, in
# 99 of 100 sketches; four times that is what is promised. A sketch of a group up to K rows is exact.
K = 4096
RANK_ERROR = 0.005


def daily_sketches(silver: DataFrame, c: Columns = DEFAULT, k: int = K) -> DataFrame:
    """One sketch of the valid amounts of each date and type: type, sketch, date."""
    cents = (F.col(c.amount) * 100).cast("long")
    return (
        silver.where(F.col(c.valid))
        .groupBy(c.date, c.type)
        .agg(F.kll_sketch_agg_bigint(cents, k).alias("sketch"))
        .select(c.type, "sketch", c.date)
    )


def merged_percentiles(
    sketches: DataFrame, c: Columns = DEFAULT, k: int = K, shares: Sequence[float] = SHARES,
    names: Sequence[str] = NAMES,
) -> DataFrame:
    """Percentiles per type over all dates of ``sketches``, and the number of amounts.

    Each value is one of the amounts; its rank is off by ``RANK_ERROR`` of the rows at most.
    """
    merged = sketches.groupBy(c.type).agg(F.kll_merge_agg_bigint("sketch", k).alias("_s"))
    value = lambda p: (F.kll_sketch_get_quantile_bigint("_s", F.lit(p)) / 100).cast("decimal(18,2)")
    return merged.select(
        c.type,
        F.kll_sketch_get_n_bigint("_s").alias("amounts"),
        *[value(p).alias(n) for p, n in zip(shares, names)],
    )


def rank_errors(
    silver: DataFrame, percentiles: DataFrame, c: Columns = DEFAULT, shares: Sequence[float] = SHARES,
    names: Sequence[str] = NAMES,
) -> DataFrame:
    """How far the ranks of given percentiles are from their shares, by one scan of the valid rows.

    A value that fills the ranks from ``a`` to ``b`` is off by 0 for every share between them. The
    percentiles are one row per type.
    """
    rows = silver.where(F.col(c.valid) & F.col(c.amount).isNotNull()).select(c.type, c.amount)
    joined = rows.join(F.broadcast(percentiles.select(c.type, *names)), c.type)
    counts = []
    for n in names:
        counts += [
            F.count_if(F.col(c.amount) < F.col(n)).alias(f"_below_{n}"),
            F.count_if(F.col(c.amount) <= F.col(n)).alias(f"_upto_{n}"),
        ]
    counted = joined.groupBy(c.type).agg(F.count("*").alias("amounts"), *counts)
    off = []
    for p, n in zip(shares, names):
        below, upto = F.col(f"_below_{n}") / F.col("amounts"), F.col(f"_upto_{n}") / F.col("amounts")
        off.append(F.greatest(below - p, F.lit(p) - upto, F.lit(0.0)).alias(n))
    return counted.select(c.type, "amounts", *off)
