"""Reconciliation by digests: layers that agree are compared without reading them.

A digest of rows is their number and the sums of two 64-bit hashes of each row, so it does not depend on
their order, and digests of parts add up to the digest of the whole. They form a tree: one digest per date,
and below it one per date and bucket of ids. Dates are compared first, buckets of differing dates next,
and only rows of differing buckets are joined.

Digests are stored beside a layer by the run that writes it (``store_digests``, for all or some dates)
and say what was written then.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstrata.columns import DEFAULT, Columns
from ledgerstrata.operators.reconcile import recon_silver_gold
from ledgerstrata.sources.keys import runtime_filter, store_rows_with_keys
from ledgerstrata.sources.layers import layer_exists, only_dates, read_layer, write_layer
from ledgerstrata.sources.scratch import cut_lineage

BUCKETS = 256
# Digests of one date fit a task many times over; both sums are exact.
_SUMS = ("rows", "first_sum", "second_sum")
_TYPES = "rows bigint, first_sum decimal(38,0), second_sum decimal(38,0)"


def bucket_of(c: Columns = DEFAULT, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(c.id), F.lit(buckets)).cast("int")


def layer_digests(
    layer: DataFrame, columns: list[str], c: Columns = DEFAULT, buckets: int = BUCKETS,
    distinct: bool = False,
) -> DataFrame:
    """Digests of ``columns`` per date and bucket of ids; rows without id share a bucket.

    With ``distinct``, equal rows of a date count once. Each task sends one row per date and bucket.
    """
    rows = layer.select(c.date, *columns)
    bucket = bucket_of(c, buckets) if c.id in columns else F.lit(0)
    if distinct:
        rows = rows.distinct()
    values = [F.col(n) for n in columns]
    # A hash skips NULL, so where NULLs stand is hashed too.
    hashed = [F.xxhash64(F.lit(seed), *values, *[v.isNull() for v in values]) for seed in (1, 2)]
    return (
        rows.select(c.date, bucket.alias("bucket"), *[h.cast("decimal(20,0)").alias(f"_{i}") for i, h in enumerate(hashed)])
        .groupBy(c.date, "bucket")
        .agg(
            F.count("*").alias("rows"),
            F.sum("_0").cast("decimal(38,0)").alias("first_sum"),
            F.sum("_1").cast("decimal(38,0)").alias("second_sum"),
        )
    )


def store_digests(
    layer: DataFrame, path: str, columns: list[str], c: Columns = DEFAULT, buckets: int = BUCKETS,
    distinct: bool = False, dates: Iterable[date | str] | None = None,
) -> None:
    """Write the tree of a layer's digests below ``path``, or renew that of some dates."""
    spark = layer.sparkSession
    dates = None if dates is None else [str(d) for d in dates]
    leaves = layer_digests(only_dates(layer, dates, c), columns, c, buckets, distinct)
    write_layer(leaves, f"{path}/buckets", c, dates=dates, clear=True)
    stored = _read(spark, f"{path}/buckets", "bucket int, ", c, dates)
    summed = [F.sum(n).cast("bigint" if n == "rows" else "decimal(38,0)").alias(n) for n in _SUMS]
    write_layer(stored.groupBy(c.date).agg(*summed), f"{path}/dates", c, dates=dates, clear=True)


def _read(
    spark: SparkSession, path: str, more: str, c: Columns, dates: Iterable[date | str] | None = None
) -> DataFrame:
    schema = f"{more}{_TYPES}, {c.date} date"
    if not layer_exists(spark, path):
        return spark.createDataFrame([], schema)
    return read_layer(spark, path, spark.createDataFrame([], schema).schema, dates, c)


def _on_dates(df: DataFrame, dates: list, c: Columns) -> DataFrame:
    """Rows of these dates, of which one may be NULL; partitions are pruned."""
    given = F.col(c.date).isin([d for d in dates if d is not None])
    return df.where(given | F.col(c.date).isNull() if None in dates else given)


def _unlike(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose digests are not the same on both sides."""
    same_key = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    differs = reduce(or_, [~F.col(f"a.{n}").eqNullSafe(F.col(f"b.{n}")) for n in _SUMS])
    joined = a.withColumn("_here", F.lit(1)).alias("a").join(b.alias("b"), same_key, "full").where(differs)
    of = lambda k: F.when(F.col("a._here") == 1, F.col(f"a.{k}")).otherwise(F.col(f"b.{k}"))
    return joined.select(*[of(k).alias(k) for k in keys])


def differing_buckets(spark: SparkSession, path: str, other: str, c: Columns = DEFAULT) -> DataFrame:
    """(date, bucket) pairs in which two stored trees differ. Only digests are read."""
    roots = [_read(spark, f"{p}/dates", "", c) for p in (path, other)]
    dates = [r[0] for r in _unlike(*roots, [c.date]).collect()]  # bounded by the calendar
    leaves = [_on_dates(_read(spark, f"{p}/buckets", "bucket int, ", c), dates, c) for p in (path, other)]
    return _unlike(*leaves, [c.date, "bucket"])


def amount_discrepancy_by_digests(
    bronze: DataFrame, silver: DataFrame, bronze_digests: str, silver_digests: str,
    c: Columns = DEFAULT, buckets: int = BUCKETS,
) -> DataFrame:
    """What ``recon_amount_discrepancy`` gives, from rows of differing buckets alone.

    The digests are those of id and amount, for Bronze with ``distinct``; Silver holds an id once. Then a
    Bronze row whose amount differs from Silver's lies in a bucket that differs, as Silver would have to
    hold its id twice otherwise. The Silver rows of these ids are looked up on all dates, and others are
    dropped at the scan. Where the trees agree no layer is read. Runs while the DataFrame is built.
    """
    spark = bronze.sparkSession
    places = cut_lineage(differing_buckets(spark, bronze_digests, silver_digests, c))
    before = bronze.select(c.id, c.date, F.col(c.amount).alias("bronze_amount"))
    dates = [r[0] for r in places.select(c.date).distinct().collect()]
    if not dates:
        schema = before.join(silver.select(c.id, F.col(c.amount).alias("silver_amount")), c.id)
        return spark.createDataFrame([], _with_delta(schema).schema)
    place = places.select(F.col(c.date).alias("_date"), F.col("bucket").alias("_bucket"))
    suspect = _on_dates(before, dates, c).join(
        place, F.col(c.date).eqNullSafe(F.col("_date")) & (bucket_of(c, buckets) == F.col("_bucket")), "left_semi"
    )
    keys = store_rows_with_keys(suspect, c.id)
    with runtime_filter(spark, keys):
        after = cut_lineage(keys.those_in(silver.select(c.id, F.col(c.amount).alias("silver_amount"))))
    return _with_delta(keys.rows.join(after, c.id))


def _with_delta(pairs: DataFrame) -> DataFrame:
    differs = ~F.col("bronze_amount").eqNullSafe(F.col("silver_amount"))
    return pairs.where(differs).withColumn("delta", F.col("bronze_amount") - F.col("silver_amount"))


def silver_gold_by_digests(
    silver: DataFrame, gold: DataFrame, silver_digests: str, gold_digests: str, verified: str,
    c: Columns = DEFAULT,
) -> DataFrame:
    """What ``recon_silver_gold`` gives, recomputing only dates that changed since they last agreed.

    ``verified`` is a folder where the digests of both layers are noted for each date on which totals and
    counts agreed. A date whose digests are still those is taken from Gold alone. The digests of Silver
    are those of type, amount and validity, with the id; those of Gold of type, total and count. Runs
    while the DataFrame is built.
    """
    spark = silver.sparkSession
    now = _pair(_read(spark, f"{silver_digests}/dates", "", c), _read(spark, f"{gold_digests}/dates", "", c), c)
    names = [n for n in now.columns if n != c.date]
    if layer_exists(spark, verified):
        noted = read_layer(spark, verified, now.schema, c=c)
        same = [now[n].eqNullSafe(noted[n]) for n in now.columns]
        trusted = [r[0] for r in now.join(noted, same, "left_semi").select(c.date).collect()]
    else:
        trusted = []
    all_dates = [r[0] for r in now.select(c.date).collect()]  # bounded by the calendar
    todo = [d for d in all_dates if d not in trusted]
    checked = cut_lineage(recon_silver_gold(_on_dates(silver, todo, c), _on_dates(gold, todo, c), c))
    wrong = (F.col("total_delta") != 0) | ~F.col("silver_count").eqNullSafe(F.col("gold_count"))
    bad = [r[0] for r in checked.where(wrong).select(c.date).distinct().collect()]
    agreed = _on_dates(now, [d for d in todo if d not in bad], c)
    write_layer(agreed.select(*names, c.date), verified, c)
    known = _on_dates(gold, trusted, c)
    total, count = F.col(c.total), F.col(c.count)
    parts = {
        c.date: F.col(c.date), c.type: F.col(c.type), "silver_total": total, "gold_total": total,
        "silver_count": count, "gold_count": count, "total_delta": F.lit(0),
    }
    from_gold = known.select(*[parts[f.name].cast(f.dataType).alias(f.name) for f in checked.schema])
    order = [F.asc_nulls_last(n) for n in (c.date, c.type, "silver_total", "gold_total")]
    return checked.unionByName(from_gold).orderBy(*order)


def _pair(silver: DataFrame, gold: DataFrame, c: Columns) -> DataFrame:
    """Digests of both layers per date, side by side."""
    named = [df.select(F.lit(1).alias("_here"), F.col(c.date), *[F.col(n).alias(f"{p}_{n}") for n in _SUMS]) for p, df in (("silver", silver), ("gold", gold))]
    a, b = named[0].alias("a"), named[1].alias("b")
    joined = a.join(b, F.col(f"a.{c.date}").eqNullSafe(F.col(f"b.{c.date}")), "full")
    day = F.when(F.col("a._here") == 1, F.col(f"a.{c.date}")).otherwise(F.col(f"b.{c.date}"))
    return cut_lineage(joined.select(*[f"{p}_{n}" for p in ("silver", "gold") for n in _SUMS], day.alias(c.date)))
