"""Discrete percentiles per group.

The exact form narrows in two scans. The first counts rows per value bucket, the second counts the
single values of the few buckets that hold a percentile. Only counts leave a task, so no group of
values is ever gathered, and the answer is the same at every scale.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerstrata.columns import DEFAULT, Columns
from ledgerstrata.functions.exprs import asc
from ledgerstrata.sources.scratch import cut_lineage

# Buckets per doubling of the absolute value: each is 0.3 % wide, about 27,000 in all.
_BUCKETS_PER_DOUBLING = 256

SILVER_PERCENTILES = {"p25": "0.25", "median": "0.50", "p75": "0.75", "p95": "0.95"}


def _bucket(value: Column) -> Column:
    """Whole number that never decreases as the value grows."""
    x = value.cast("double")
    steps = F.floor(F.log2(F.abs(x) + 1) * _BUCKETS_PER_DOUBLING)
    return (F.signum(x) * steps).cast("bigint")


def discrete_percentiles(
    df: DataFrame, group: str, value: str, percentiles: dict[str, str | float]
) -> DataFrame:
    """Smallest value at or below which at least the given share of a group's rows lies.

    One row per group, one column per entry of ``percentiles`` (name to share). NULL values do not
    count; a group of NULLs only has NULL percentiles. The first scan runs, and its counts are stored
    in the checkpoint folder, while the DataFrame is built.
    """
    values = df.select(F.col(group), F.col(value), _bucket(F.col(value)).alias("_bucket"))
    counts = cut_lineage(values.groupBy(group, "_bucket").agg(F.count(value).alias("_rows")))

    whole = Window.partitionBy(group)
    upto = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wanted = F.array(
        *[
            F.struct(F.lit(name).alias("name"), F.lit(Decimal(str(p))).alias("share"))
            for name, p in percentiles.items()
        ]
    )
    targets = (
        counts.where("_bucket IS NOT NULL")
        .select(
            F.col(group),
            "_bucket",
            "_rows",
            F.sum("_rows").over(upto).alias("_upto"),
            F.sum("_rows").over(whole).alias("_total"),
        )
        .withColumn("_want", F.explode(wanted))
        .withColumn("_rank", F.greatest(F.ceil(F.col("_want.share") * F.col("_total")), F.lit(1)))
        .where("_rank <= _upto AND _rank > _upto - _rows")
        .select(
            F.col(group).alias("_group"),
            F.col("_bucket").alias("_in_bucket"),
            F.col("_want.name").alias("_name"),
            (F.col("_rank") - (F.col("_upto") - F.col("_rows"))).alias("_rank_in_bucket"),
        )
    )
    same_bucket = F.col(group).eqNullSafe(F.col("_group")) & (
        F.col("_bucket") == F.col("_in_bucket")
    )
    # Counted before the join: a popular value leaves each task as one row.
    value_counts = (
        values.groupBy(group, "_bucket", value)
        .agg(F.count("*").alias("_rows"))
        .join(targets.select("_group", "_in_bucket").distinct(), same_bucket, "left_semi")
    )
    by_value = (
        Window.partitionBy(group, "_bucket")
        .orderBy(value)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = (
        value_counts.withColumn("_upto", F.sum("_rows").over(by_value))
        .join(targets, same_bucket)
        .where("_rank_in_bucket <= _upto AND _rank_in_bucket > _upto - _rows")
        .select(group, "_name", value)
    )
    all_groups = counts.select(group, F.lit(None).alias("_name"), F.lit(None).alias(value)).distinct()
    return (
        found.union(all_groups)
        .groupBy(group)
        .agg(
            *[F.max(F.when(F.col("_name") == n, F.col(value))).alias(n) for n in percentiles]
        )
    )


def approx_percentiles(
    df: DataFrame,
    group: str,
    value: str,
    percentiles: dict[str, str | float],
    accuracy: int = 10_000,
) -> DataFrame:
    """One scan with ``percentile_approx``; ranks are off by at most one in ``accuracy``."""
    shares = [float(p) for p in percentiles.values()]
    return (
        df.groupBy(group)
        .agg(F.percentile_approx(value, shares, accuracy).alias("_p"))
        .select(group, *[F.col("_p")[i].alias(n) for i, n in enumerate(percentiles)])
    )


def silver_percentiles(
    silver: DataFrame,
    c: Columns = DEFAULT,
    percentiles: dict[str, str | float] | None = None,
    accuracy: int | None = None,
) -> DataFrame:
    """Percentiles of valid amounts per type: exact, or approximate when ``accuracy`` is given."""
    valid = silver.where(F.col(c.valid))
    wanted = percentiles or SILVER_PERCENTILES
    if accuracy is None:
        result = discrete_percentiles(valid, c.type, c.amount, wanted)
    else:
        result = approx_percentiles(valid, c.type, c.amount, wanted, accuracy)
    return result.orderBy(*asc(c.type))
