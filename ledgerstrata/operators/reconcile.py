"""Checks between layers.

A transaction id repeated on both sides counts once per pair of rows. Where only counts, sums or
presence are asked for, both sides are first reduced to one row per id and what else is grouped by, so
an id with very many rows leaves each task as one row and pairs are multiplied instead of built. Joins
that return rows are left to adaptive execution, which splits the partition of a hot or missing id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerstrata.columns import DEFAULT, Columns
from ledgerstrata.functions.exprs import asc, money, ratio
from ledgerstrata.operators.analytics import daily_totals
from ledgerstrata.sources.keys import runtime_filter, store_rows_with_keys
from ledgerstrata.sources.scratch import cut_lineage


def _counted(df: DataFrame, name: str, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias(name))


def recon_layer_counts(bronze: DataFrame, silver: DataFrame, c: Columns = DEFAULT) -> DataFrame:
    """Distinct ids per Bronze date, and how many of them Silver does not hold on any date."""
    ids = bronze.select(c.date, c.id).distinct()
    kept = silver.select(c.id).distinct().withColumn("_kept", F.lit(True))
    return (
        ids.join(kept, c.id, "left")
        .groupBy(c.date)
        .agg(F.count(c.id).alias("bronze_count"), F.count("_kept").alias("silver_count"))
        .withColumn("dropped_in_silver", F.col("bronze_count") - F.col("silver_count"))
        .orderBy(*asc(c.date))
    )


def recon_missing_in_silver(
    bronze: DataFrame, silver: DataFrame, c: Columns = DEFAULT
) -> DataFrame:
    """Bronze rows, all columns, whose id Silver does not hold. Rows without id are among them.

    Silver ids are not made distinct first: adaptive execution splits the rows of a hot or missing id
    only where both sides come straight from their shuffles.
    """
    return bronze.join(silver.select(c.id), c.id, "left_anti").select(*bronze.columns)


def recon_amount_discrepancy(
    bronze: DataFrame, silver: DataFrame, c: Columns = DEFAULT
) -> DataFrame:
    """Pairs of rows whose amounts differ, counting NULL against a value as different."""
    before = bronze.select(c.id, c.date, F.col(c.amount).alias("bronze_amount"))
    after = silver.select(c.id, F.col(c.amount).alias("silver_amount"))
    return (
        before.join(after, c.id)
        .where(~F.col("bronze_amount").eqNullSafe(F.col("silver_amount")))
        .withColumn("delta", F.col("bronze_amount") - F.col("silver_amount"))
    )


def recon_type_mismatch(bronze: DataFrame, silver: DataFrame, c: Columns = DEFAULT) -> DataFrame:
    before = _counted(bronze, "_n", c.id, c.type).withColumnRenamed(c.type, "bronze_type")
    after = _counted(silver, "_m", c.id, c.type).withColumnRenamed(c.type, "silver_type")
    return (
        before.join(after, c.id)
        .where(F.col("bronze_type") != F.col("silver_type"))
        .groupBy("bronze_type", "silver_type")
        .agg(F.sum(F.col("_n") * F.col("_m")).alias("mismatch_count"))
    )


def _dates_not_in(left: DataFrame, right: DataFrame, date: str) -> DataFrame:
    # NOT IN, not an anti join: one NULL on the right leaves no row. Both sides are reduced to
    # distinct dates first, so what the null-aware join broadcasts is bounded by the calendar.
    return (
        left.select(date)
        .distinct()
        .where(~F.col(date).isin(right.select(date).distinct()))
        .orderBy(*asc(date))
    )


def recon_dates_bronze_not_silver(
    bronze: DataFrame, silver: DataFrame, c: Columns = DEFAULT
) -> DataFrame:
    return _dates_not_in(bronze, silver, c.date)


def recon_dates_silver_not_gold(
    silver: DataFrame, gold: DataFrame, c: Columns = DEFAULT
) -> DataFrame:
    return _dates_not_in(silver, gold, c.date)


def recon_silver_gold(silver: DataFrame, gold: DataFrame, c: Columns = DEFAULT) -> DataFrame:
    """Gold recomputed from Silver beside Gold as stored; a delta of 0 means they agree."""
    computed = daily_totals(silver, c).alias("s")
    stored = gold.alias("g")
    same_group = [F.col(f"s.{k}") == F.col(f"g.{k}") for k in (c.date, c.type)]
    zero = F.lit(0)
    return (
        computed.join(stored, same_group, "full")
        .select(
            F.coalesce(f"g.{c.date}", f"s.{c.date}").alias(c.date),
            F.coalesce(f"g.{c.type}", f"s.{c.type}").alias(c.type),
            F.col(f"s.{c.total}").alias("silver_total"),
            F.col(f"g.{c.total}").alias("gold_total"),
            F.col(f"s.{c.count}").alias("silver_count"),
            F.col(f"g.{c.count}").alias("gold_count"),
            money(
                F.coalesce(F.col(f"s.{c.total}"), zero) - F.coalesce(F.col(f"g.{c.total}"), zero), 4
            ).alias("total_delta"),
        )
        .orderBy(*asc(c.date, c.type, "silver_total", "gold_total"))
    )


def silver_coverage(
    bronze: DataFrame, silver: DataFrame, c: Columns = DEFAULT, by: str = "silver"
) -> DataFrame:
    """Silver rows as a percentage of Bronze rows with the same id and date.

    ``by="silver"`` groups by the Silver date of the outer join: every date shows 100 % and the
    unmatched rows share one group without date. ``by="bronze"`` groups by the Bronze date, which
    shows where rows are missing.
    """
    before = _counted(bronze, "_n", c.id, c.date).withColumn("_bronze_date", F.col(c.date))
    after = _counted(silver, "_m", c.id, c.date).withColumn("_silver_date", F.col(c.date))
    joined = before.join(after, [c.id, c.date], "left")
    pairs = F.col("_n") * F.coalesce("_m", F.lit(1))
    silver_rows, bronze_rows = F.col("silver_row_count"), F.col("bronze_row_count")
    return (
        joined.groupBy(F.col(f"_{by}_date").alias(c.date))
        .agg(
            F.sum(F.when(F.col("_m").isNotNull(), pairs).otherwise(0)).alias("silver_row_count"),
            F.sum(F.when(F.col(c.id).isNotNull(), pairs).otherwise(0)).alias("bronze_row_count"),
        )
        .withColumn("silver_coverage_pct", ratio(silver_rows * 100, bronze_rows, 1))
        .orderBy(*asc(c.date))
    )


def matched_by_type(
    bronze: DataFrame, silver: DataFrame, c: Columns = DEFAULT, where: str | None = None
) -> DataFrame:
    """Row pairs that share an id, counted by Bronze type.

    ``where`` is an optional condition on the Bronze columns, e.g. on the type.
    """
    source = bronze if where is None else bronze.where(where)
    return (
        _counted(source, "_n", c.id, c.type)
        .join(_counted(silver, "_m", c.id), c.id)
        .groupBy(F.col(c.type).alias("trans_type"))
        .agg(F.sum(F.col("_n") * F.col("_m")).alias("total_transactions"))
    )


def medallion_journey(
    bronze: DataFrame, silver: DataFrame, c: Columns = DEFAULT, n: int = 50
) -> DataFrame:
    """The first ``n`` Bronze rows beside their Silver rows and the Silver total of date and type.

    Every row of the outer join comes from one Bronze row and sorts by Bronze columns first, so the
    first n Bronze rows are enough to find the result. They are found once and stored; then only
    their groups are totalled, reading only their dates. Silver rows that no such group needs are
    dropped where Silver is scanned. These steps run while the DataFrame is built and store what they
    find (at most n rows and groups, and the ids of the groups) in shared scratch storage.
    """
    keys = asc(c.date, c.type, c.id, "bronze_amount")
    first = cut_lineage(
        bronze.select(c.id, c.date, c.type, F.col(c.amount).alias("bronze_amount"))
        .orderBy(*keys)
        .limit(n)
    )
    wanted_ids = [row[0] for row in first.select(c.id).distinct().collect()]  # at most n
    found = silver.where(F.col(c.id).isin([i for i in wanted_ids if i is not None])).select(
        c.id, F.col(c.valid).alias("silver_valid"), F.col(c.amount).alias("silver_amount")
    )
    order = keys + asc("silver_amount", "silver_valid")
    rows = first.join(found, c.id, "left").orderBy(*order).limit(n)

    groups = first.select(F.col(c.date).alias("_date"), F.col(c.type).alias("_type")).distinct()
    same_group = F.col(c.date).eqNullSafe(F.col("_date")) & F.col(c.type).eqNullSafe(F.col("_type"))
    dates = [row[0] for row in first.select(c.date).distinct().collect()]  # at most n
    in_dates = F.col(c.date).isin([d for d in dates if d is not None])
    if None in dates:
        in_dates = in_dates | F.col(c.date).isNull()
    in_groups = (
        bronze.where(in_dates & F.col(c.id).isNotNull())
        .join(groups, same_group)
        .select(c.id, "_date", "_type")
    )
    ids = store_rows_with_keys(_counted(in_groups, "_n", "_date", "_type", c.id), c.id)
    amounts = ids.those_in(silver.select(c.id, c.amount)).groupBy(c.id).agg(F.sum(c.amount).alias("_amount"))
    with runtime_filter(silver.sparkSession, ids):
        totals = cut_lineage(
            ids.rows.join(amounts, c.id)
            .groupBy("_date", "_type")
            .agg(money(F.sum(F.col("_n") * F.col("_amount"))).alias("daily_type_total"))
        )
    return (
        rows.join(totals, same_group, "left")
        .select(
            c.id, c.date, c.type, "bronze_amount", "silver_valid", "silver_amount",
            "daily_type_total",
        )
        .orderBy(*order)
    )


def freshness(
    bronze: DataFrame, silver: DataFrame, gold: DataFrame, c: Columns = DEFAULT
) -> DataFrame:
    """Last date per layer. Reads partition values only."""
    layers = {"bronze": bronze, "silver": silver, "gold": gold}
    parts = [
        df.agg(F.max(c.date).alias("last_partition")).select(F.lit(name).alias("layer"), "last_partition")
        for name, df in layers.items()
    ]
    return parts[0].union(parts[1]).union(parts[2]).orderBy("layer")
