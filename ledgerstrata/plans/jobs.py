"""The jobs that build the layers: pure DataFrame steps, and runs that read and write paths.

The cleaning rules are this library's own choice and are parameters where they are likely to vary.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerstrata.columns import DEFAULT, Columns
from ledgerstrata.operators.analytics import daily_totals
from ledgerstrata.sources import schemas
from ledgerstrata.sources.layers import (
    layer_dates,
    layer_exists,
    only_dates,
    read_layer,
    write_layer,
)
from ledgerstrata.sources.keys import StoredKeys, runtime_filter, store_keys
from ledgerstrata.sources.scratch import cut_lineage

AMOUNT_LIMIT = 1_000_000


@dataclass(frozen=True)
class LayerPaths:
    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze_transactions"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver_transactions"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold_transactions"

    @property
    def rejects(self) -> str:
        return f"{self.root}/rejected_transactions"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine_transactions"

    def as_dict(self) -> dict[str, str]:
        return {"bronze": self.bronze, "silver": self.silver, "gold": self.gold}


def ingest_bronze(raw: DataFrame, c: Columns = DEFAULT) -> DataFrame:
    """Type raw text columns. Rows are never dropped: text that does not parse becomes NULL.

    The date is the raw one if there is such a column, otherwise that of ``booked_at``.
    """
    booked_at = F.col(c.booked_at).try_cast("timestamp_ntz")
    booked_date = F.col(c.date).try_cast("date") if c.date in raw.columns else booked_at.cast("date")
    return raw.select(
        F.nullif(F.trim(c.id), F.lit("")).alias(c.id),
        booked_at.alias(c.booked_at),
        F.col(c.amount).try_cast(schemas.MONEY).alias(c.amount),
        F.nullif(F.trim(c.type), F.lit("")).alias(c.type),
        booked_date.alias(c.date),
    )


def _required(c: Columns) -> list[str]:
    return [c.id, c.booked_at, c.type]


def _complete(bronze: DataFrame, c: Columns) -> DataFrame:
    """Rows that can enter Silver."""
    return bronze.where(reduce(and_, [F.col(n).isNotNull() for n in _required(c)]))


def _incomplete(bronze: DataFrame, c: Columns) -> DataFrame:
    """The other rows, with what they lack first. Both filters reach the Parquet scan."""
    reason = (
        F.when(F.col(c.id).isNull(), "missing_id")
        .when(F.col(c.booked_at).isNull(), "missing_time")
        .otherwise("missing_type")
    )
    lacking = reduce(or_, [F.col(n).isNull() for n in _required(c)])
    return bronze.where(lacking).withColumn("reason", reason)


def _placed(complete: DataFrame, c: Columns) -> DataFrame:
    """Number the rows of each id, latest first.

    A condition on one place is applied in each task before the shuffle, so an id with very many
    rows then sends one row per task.
    """
    latest_first = Window.partitionBy(c.id).orderBy(
        F.col(c.booked_at).desc(),
        F.col(c.amount).desc_nulls_last(),
        F.col(c.type).asc(),
        F.col(c.date).desc_nulls_last(),
    )
    return complete.withColumn("_place", F.row_number().over(latest_first))


def clean_silver(bronze: DataFrame, c: Columns = DEFAULT, limit: int = AMOUNT_LIMIT) -> DataFrame:
    """One row per id, the latest, with normalized type. Unusual amounts stay and are flagged."""
    usual = (F.col(c.amount) != 0) & (F.abs(F.col(c.amount)) <= limit)
    latest = _placed(_complete(bronze, c), c).where("_place = 1")
    return latest.select(
        c.id,
        c.booked_at,
        c.amount,
        F.lower(F.trim(c.type)).alias(c.type),
        F.coalesce(usual, F.lit(False)).alias(c.valid),
        c.date,
    )


def rejected_rows(bronze: DataFrame, c: Columns = DEFAULT) -> DataFrame:
    """What ``clean_silver`` drops: each distinct row once, with the reason and its number.

    Identical rows are counted where they are read, and one is taken away from the row that each id
    keeps. Sums are by whole rows and minima by id, so no group of rows is ever gathered.
    """
    columns = [c.id, c.booked_at, c.amount, c.type, c.date]
    epoch = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    # The least of these is the row that an id keeps, and each can be turned back into its row.
    place = F.struct(
        (-(F.col(c.booked_at) - epoch)).alias("at"),
        F.col(c.amount).isNull().alias("no_amount"),
        (-F.col(c.amount)).alias("amount"),
        F.col(c.type).alias("type"),
        F.col(c.date).isNull().alias("no_date"),
        (-F.unix_date(F.col(c.date))).alias("date"),
    )
    counted = (
        _complete(bronze, c)
        .groupBy(*columns)
        .agg(F.count("*").alias("copies"))
        .withColumn("_place", place)
    )
    # The sign of the sum is 1; it makes both uses of the counts alike, so they are shuffled once.
    kept = (
        counted.groupBy(c.id)
        .agg(F.min("_place").alias("_kept"), (-F.signum(F.sum("copies"))).alias("copies"))
        .select(
            c.id,
            (epoch - F.col("_kept.at")).alias(c.booked_at),
            (-F.col("_kept.amount")).alias(c.amount),
            F.col("_kept.type").alias(c.type),
            F.date_from_unix_date(-F.col("_kept.date")).alias(c.date),
            F.col("copies").cast("long"),
        )
    )
    duplicates = (
        counted.select(*columns, "copies")
        .unionByName(kept)
        .groupBy(*columns)
        .agg(F.sum("copies").alias("copies"))
        .where("copies > 0")
        .withColumn("reason", F.lit("duplicate"))
    )
    missing = _incomplete(bronze, c).groupBy(*columns, "reason").agg(F.count("*").alias("copies"))
    return duplicates.unionByName(missing).select(
        c.id, c.booked_at, c.amount, c.type, "reason", "copies", c.date
    )


def build_gold(silver: DataFrame, c: Columns = DEFAULT) -> DataFrame:
    return daily_totals(silver, c).select(
        c.type, F.col(c.total).cast(schemas.MONEY).alias(c.total), c.count, c.date
    )


def run_bronze(raw: DataFrame, paths: LayerPaths, dates: Iterable[date | str] | None = None) -> None:
    """Store raw rows as Bronze; dates that got no rows are emptied.

    With ``dates``, rows of other dates are left to their own runs. Rows whose date cannot be told
    belong to no dated run: they go to the quarantine, in the folder of this run, and a repeated run
    replaces them. Without ``dates`` they are stored in Bronze without date.
    """
    bronze = ingest_bronze(raw)
    if dates is None:
        write_layer(bronze, paths.bronze, clear=True)
        return
    dates = [str(d) for d in dates]
    write_layer(only_dates(bronze, dates), paths.bronze, dates=dates, clear=True)
    run = f"{min(dates)}_{max(dates)}_{len(dates)}"
    undated = bronze.where(F.col(DEFAULT.date).isNull()).withColumn("reason", F.lit("missing_date"))
    (
        undated.withColumn("run", F.lit(run))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run")
        .parquet(paths.quarantine)
    )


def run_silver(
    spark: SparkSession,
    paths: LayerPaths,
    dates: Iterable[date | str] | None = None,
    limit: int = AMOUNT_LIMIT,
) -> list[str] | None:
    """Clean Bronze into Silver and store the rejected rows; returns the dates that were replaced.

    A dated run gives what a run over all these dates together would: an id is unique across dates.
    Dates that were stored before and share an id with ``dates``, in Bronze as it is or in Silver as
    it was, are cleaned again, and an id that another stored date holds stays there. Pass the
    returned dates on to ``run_gold``. Dates that got no rows are emptied. None means all dates.

    Of other dates a run reads the id column only, and a Bloom filter over its own ids drops the rest
    in the scan: what is shuffled grows with the run, not with the history.
    """
    c = DEFAULT
    bronze = read_layer(spark, paths.bronze, schemas.BRONZE)
    if dates is None:
        write_layer(clean_silver(bronze, limit=limit), paths.silver, clear=True)
        write_layer(rejected_rows(bronze), paths.rejects, clear=True)
        return None
    dates = {str(d) for d in dates}
    stored = _stored_dates(spark, paths.silver) | _stored_dates(spark, paths.rejects)
    todo, keys = dates, None
    if stored - dates:
        ids = only_dates(bronze, dates).select(c.id)
        if _stored_dates(spark, paths.silver):
            ids = ids.union(read_layer(spark, paths.silver, schemas.SILVER, dates).select(c.id))
        keys = store_keys(ids, c.id)
        todo = dates | dates_with_keys(bronze, keys, sorted(stored - dates), c)
    dates_todo = sorted(todo)
    taken = only_dates(bronze, dates_todo)
    elsewhere = stored - todo
    if elsewhere:
        if todo != dates:
            keys = store_keys(taken, c.id)
        held = read_layer(spark, paths.silver, schemas.SILVER, sorted(elsewhere)).select(c.id)
        with runtime_filter(spark, keys):
            again = cut_lineage(keys.those_in(held).distinct())
        later = taken.join(again, c.id, "left_semi").where(F.col(c.id).isNotNull())
        free = taken.join(again, c.id, "left_anti")
    else:
        later, free = None, taken
    silver = cut_lineage(clean_silver(free, limit=limit))
    rejects = rejected_rows(free)
    if later is not None:
        # Ids that another date holds: all their complete rows here are duplicates.
        columns = [c.id, c.booked_at, c.amount, c.type, c.date]
        duplicate = _complete(later, c).groupBy(*columns).agg(F.count("*").alias("copies"))
        lacking = _incomplete(later, c).groupBy(*columns, "reason").agg(F.count("*").alias("copies"))
        rejects = rejects.unionByName(duplicate.withColumn("reason", F.lit("duplicate")))
        rejects = rejects.unionByName(lacking)
    rejects = cut_lineage(rejects)
    write_layer(silver, paths.silver, dates=dates_todo, clear=True)
    write_layer(rejects, paths.rejects, dates=dates_todo, clear=True)
    return dates_todo


def dates_with_keys(
    bronze: DataFrame, keys: StoredKeys, dates: Iterable[date | str], c: Columns = DEFAULT
) -> set[str]:
    """Which of ``dates`` hold an id of a set. Ids of these dates are scanned, and filtered there."""
    found = keys.those_in(only_dates(bronze, dates, c).select(c.id, c.date)).select(c.date).distinct()
    with runtime_filter(bronze.sparkSession, keys):
        return {str(r[0]) for r in found.collect()}


def _stored_dates(spark: SparkSession, path: str) -> set[str]:
    """Dates of a stored layer from its directories; none if it does not exist."""
    if not layer_exists(spark, path):
        return set()
    found = layer_dates(spark, path).where(F.col(DEFAULT.date).isNotNull()).collect()
    return {str(r[0]) for r in found}


def run_gold(
    spark: SparkSession, paths: LayerPaths, dates: Iterable[date | str] | None = None
) -> None:
    """Total Silver into Gold; dates that got no rows are emptied."""
    dates = None if dates is None else [str(d) for d in dates]
    silver = read_layer(spark, paths.silver, schemas.SILVER, dates)
    write_layer(build_gold(silver), paths.gold, dates=dates, clear=True)
