"""Exact distinct counts that add up: ids numbered once, bitmaps of their numbers per date.

A dictionary gives each id a number when a run first meets it, and keeps it. A layer's bitmaps say, per
date, which numbers occur there. Bitmaps of several dates are united by a bitwise or, so the distinct ids
of any span of dates, and those that two layers share, are counted without reading an id.

New ids are numbered in the order of their first date, so the ids of a date lie close together and its
bitmaps are dense: about one bit per id and date. Layers whose bitmaps are compared share a dictionary.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstrata.columns import DEFAULT, Columns
from ledgerstrata.functions.exprs import asc
from ledgerstrata.sources.keys import runtime_filter, store_rows_with_keys
from ledgerstrata.sources.layers import only_dates, read_layer, write_layer
from ledgerstrata.sources.scratch import cut_lineage

# Numbers in one bitmap, as Spark's bitmap functions have it.
BITS = 32_768


def _dictionary(spark: SparkSession, path: str, c: Columns) -> DataFrame:
    schema = f"{c.id} string, number long"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def store_bitmaps(
    layer: DataFrame, path: str, dictionary: str, c: Columns = DEFAULT,
    dates: Iterable[date | str] | None = None,
) -> None:
    """Write the bitmaps of a layer's ids per date below ``path``, or renew those of some dates.

    Ids that the dictionary lacks are numbered and added to it first; one run at a time may do that. Ids
    of the dictionary that do not occur in the run are dropped where it is scanned.
    """
    spark = layer.sparkSession
    dates = None if dates is None else [str(d) for d in dates]
    found = cut_lineage(only_dates(layer, dates, c).select(c.date, c.id).distinct())
    first = found.groupBy(c.id).agg(F.min(c.date).alias("_first"))
    keys = store_rows_with_keys(first, c.id)
    known = _dictionary(spark, dictionary, c)
    with runtime_filter(spark, keys):
        held = cut_lineage(keys.those_in(known))
    top = known.agg(F.max("number")).first()[0] or 0
    start = -(-top // BITS) * BITS + 1  # a bitmap holds numbers of one run
    (
        keys.rows.join(held, c.id, "left_anti")
        .repartitionByRange(F.asc_nulls_last("_first"), c.id)
        .sortWithinPartitions(F.asc_nulls_last("_first"), c.id)
        .select(c.id, (F.monotonically_increasing_id() + start).alias("number"))
        .write.mode("append")
        .parquet(dictionary)
    )
    with runtime_filter(spark, keys):
        numbers = cut_lineage(keys.those_in(_dictionary(spark, dictionary, c)))
    bitmaps = (
        found.join(numbers, c.id, "left")
        # Rows without id have no number; they leave their date an empty bitmap.
        .groupBy(c.date, F.bitmap_bucket_number("number").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bitmap"))
    )
    write_layer(bitmaps, path, c, dates=dates, clear=True)


def read_bitmaps(
    spark: SparkSession, path: str, c: Columns = DEFAULT, dates: Iterable[date | str] | None = None
) -> DataFrame:
    schema = spark.createDataFrame([], f"bucket long, bitmap binary, {c.date} date").schema
    return read_layer(spark, path, schema, dates, c)


def distinct_ids(bitmaps: DataFrame, *by: Column) -> DataFrame:
    """Distinct ids of all dates of ``bitmaps``, or per group of dates: ``distinct_ids``."""
    united = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    names = united.columns[: len(by)]
    count = F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0)).cast("long")
    return united.groupBy(*names).agg(count.alias("distinct_ids"))


def layer_counts_by_bitmaps(bronze: DataFrame, silver: DataFrame, c: Columns = DEFAULT) -> DataFrame:
    """What ``recon_layer_counts`` gives, from the bitmaps of both layers."""
    kept = silver.groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("_kept"))
    both = bronze.join(kept, "bucket", "left")
    shared = (
        both.where("_kept IS NOT NULL")
        .select(c.date, "bucket", F.explode(F.array("bitmap", "_kept")).alias("bitmap"))
        .groupBy(c.date, "bucket")
        .agg(F.bitmap_count(F.bitmap_and_agg("bitmap")).alias("_shared"))
        .groupBy(c.date)
        .agg(F.sum("_shared").alias("_shared"))
    )
    counted = bronze.groupBy(c.date).agg(F.sum(F.bitmap_count("bitmap")).alias("bronze_count")).alias("a")
    shared = shared.alias("b")
    kept_ids = F.coalesce(F.col("b._shared"), F.lit(0))
    return (
        counted.join(shared, F.col(f"a.{c.date}").eqNullSafe(F.col(f"b.{c.date}")), "left")
        .select(F.col(f"a.{c.date}"), "bronze_count", kept_ids.alias("silver_count"))
        .withColumn("dropped_in_silver", F.col("bronze_count") - F.col("silver_count"))
        .orderBy(*asc(c.date))
    )
