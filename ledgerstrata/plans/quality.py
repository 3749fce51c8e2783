"""Data-quality rules over the three layers as one table of results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerstrata.columns import DEFAULT, Columns
from ledgerstrata.operators import reconcile
from ledgerstrata.sources.schemas import TRANSACTION_TYPES


def _failing(rules: dict[str, Column]) -> list[Column]:
    return [F.coalesce(n, F.lit(0)).cast("bigint").alias(rule) for rule, n in rules.items()]


def _as_rows(layer: str, rules: dict[str, Column]) -> Column:
    """Array of (layer, rule, failing) from the columns that ``_failing`` made."""
    return F.array(
        *[
            F.struct(F.lit(layer).alias("layer"), F.lit(r).alias("rule"), F.col(r).alias("failing"))
            for r in rules
        ]
    )


def _layer(df: DataFrame, layer: str, rules: dict[str, Column], c: Columns) -> DataFrame:
    """One row for a layer from one aggregation: its rules, its dates, and whether any is missing.

    There are as many dates as the calendar has.
    """
    return df.agg(
        *_failing(rules),
        F.collect_set(c.date).alias("dates"),
        F.count_if(F.col(c.date).isNull()).alias("undated"),
    ).select(F.lit(layer).alias("name"), _as_rows(layer, rules).alias("rules"), "dates", "undated")


def _gate(df: DataFrame, name: str, rules: dict[str, Column]) -> DataFrame:
    """One row for a gate between layers, in the form of ``_layer``."""
    return df.agg(*_failing(rules)).select(
        F.lit(name).alias("name"),
        _as_rows(name, rules).alias("rules"),
        F.array().cast("array<date>").alias("dates"),
        F.lit(0).cast("bigint").alias("undated"),
    )


def _date_gap(left: str, right: str, gate: str, rule: str) -> Column:
    """Dates of one layer that another lacks, as NOT IN counts them: none if it has a NULL date."""
    here, there = F.col(f"{left}.dates"), F.col(f"{right}.dates")
    undated_too = F.when((F.size(there) == 0) & (F.col(f"{left}.undated") > 0), 1).otherwise(0)
    missing = F.size(F.array_except(here, there)) + undated_too
    failing = F.when(F.col(f"{right}.undated") > 0, 0).otherwise(missing).cast("bigint")
    return F.struct(F.lit(gate).alias("layer"), F.lit(rule).alias("rule"), failing.alias("failing"))


def _id_gate(bronze: DataFrame, silver: DataFrame, c: Columns) -> DataFrame:
    """One join that serves both rules by id: amounts of each id with the numbers of their rows."""
    before = (
        bronze.where(F.col(c.id).isNotNull())
        .groupBy(c.id, F.col(c.amount).alias("_before"))
        .agg(F.count("*").alias("_n"))
    )
    after = silver.groupBy(c.id, F.col(c.amount).alias("_after")).agg(F.count("*").alias("_m"))
    return before.join(after, c.id, "left")


def quality_report(
    bronze: DataFrame,
    silver: DataFrame,
    gold: DataFrame,
    c: Columns = DEFAULT,
    types: Sequence[str] = tuple(TRANSACTION_TYPES),
) -> DataFrame:
    """One row per rule: layer, rule, number of failing rows (or ids, dates, groups), passed."""
    id_, amount, type_ = F.col(c.id), F.col(c.amount), F.col(c.type)
    repeated = F.count(id_) - F.count_distinct(id_)
    in_bronze = _layer(
        bronze,
        "bronze",
        {
            "id_present": F.count_if(id_.isNull()),
            "time_present": F.count_if(F.col(c.booked_at).isNull()),
            "amount_present": F.count_if(amount.isNull()),
            "type_present": F.count_if(type_.isNull()),
            "type_normalized": F.count_if(type_ != F.lower(F.trim(type_))),
            "id_unique": repeated,
        },
        c,
    )
    in_silver = _layer(
        silver,
        "silver",
        {
            "id_present": F.count_if(id_.isNull()),
            "type_known": F.count_if(~F.coalesce(type_.isin(*types), F.lit(False))),
            "valid_amount_present": F.count_if(F.col(c.valid) & amount.isNull()),
            "amount_valid": F.count_if(~F.coalesce(F.col(c.valid), F.lit(False))),
            "id_unique": repeated,
        },
        c,
    )
    in_gold = _layer(
        gold,
        "gold",
        {
            "total_present": F.count_if(F.col(c.total).isNull()),
            "count_positive": F.count_if(F.coalesce(F.col(c.count), F.lit(0)) <= 0),
        },
        c,
    )
    gold_gate = reconcile.recon_silver_gold(silver, gold, c)
    same_count = F.col("silver_count").eqNullSafe(F.col("gold_count"))
    parts = [
        in_bronze,
        in_silver,
        in_gold,
        _gate(
            _id_gate(bronze, silver, c),
            "bronze_silver",
            {
                "id_in_silver": F.sum(F.when(F.col("_m").isNull(), F.col("_n"))),
                "amount_kept": F.sum(
                    F.when(
                        ~F.col("_before").eqNullSafe(F.col("_after")), F.col("_n") * F.col("_m")
                    )
                ),
            },
        ),
        _gate(
            gold_gate,
            "silver_gold",
            {
                "total_matches": F.count_if(F.col("total_delta") != 0),
                "count_matches": F.count_if(~same_count),
            },
        ),
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    # Five rows, brought together as one.
    of = lambda name: F.max(F.when(F.col("name") == name, F.struct("dates", "undated"))).alias(name)
    together = rows.agg(
        F.flatten(F.collect_list("rules")).alias("rules"), of("bronze"), of("silver"), of("gold")
    )
    gaps = F.array(
        _date_gap("bronze", "silver", "bronze_silver", "date_in_silver"),
        _date_gap("silver", "gold", "silver_gold", "date_in_gold"),
    )
    return (
        together.select(F.explode(F.concat("rules", gaps)).alias("r"))
        .select("r.layer", "r.rule", "r.failing")
        .withColumn("passed", F.col("failing") == 0)
        .orderBy("layer", "rule")
    )
