"""Every query by name, each over whole layers derived from the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.layers import SampleLayers
from ledgerstrata.functions.exprs import week_start
from ledgerstrata.operators import analytics, audits, reconcile, sketches
from ledgerstrata.operators.drift import drift, value_counts
from ledgerstrata.operators.percentiles import silver_percentiles
from ledgerstrata.plans import carries, jobs
from ledgerstrata.plans.compaction import compact_layer, compact_published
from ledgerstrata.plans.curve import cluster_layer
from ledgerstrata.plans.digests import (
    amount_discrepancy_by_digests,
    silver_gold_by_digests,
    store_digests,
)
from ledgerstrata.plans.distinct import (
    distinct_ids,
    layer_counts_by_bitmaps,
    read_bitmaps,
    store_bitmaps,
)
from ledgerstrata.plans.jobs import LayerPaths
from ledgerstrata.plans.quality import quality_report
from ledgerstrata.sources import schemas
from ledgerstrata.sources.buckets import read_colocated, write_bucketed
from ledgerstrata.sources.catalog import register_layers, table_name
from ledgerstrata.sources.layers import read_layer, read_table, stored_files, write_layer
from ledgerstrata.sources.published import publish_layer, read_published
from ledgerstrata.sources.scratch import scratch_path
from ledgerstrata.streaming.arrivals import (
    ArrivalStore,
    raw_schema,
    read_arrivals,
    take_new_files,
)


def _stored(df: DataFrame, schema: T.StructType) -> DataFrame:
    path = scratch_path(df.sparkSession, "layer")
    write_layer(df, path)
    return read_layer(df.sparkSession, path, schema)


def _partition_dirs(df: DataFrame) -> DataFrame:
    """Store a layer and list its files, reduced to what does not vary from run to run."""
    path = scratch_path(df.sparkSession, "layer")
    write_layer(df, path)
    directory = F.regexp_extract("file_path", "/([^/]+)/[^/]+$", 1)
    files = stored_files(df.sparkSession, path)
    return files.select("booked_date", directory.alias("directory")).distinct()


def _by_name(t: SampleLayers) -> DataFrame:
    """Store Silver, register it as a table and read it by name, with the directory of each file."""
    spark, path = t.spark, scratch_path(t.spark, "layer")
    write_layer(t.silver_clean, path)
    spark.sql(f"DROP TABLE IF EXISTS {table_name('silver', 'default')}")
    register_layers(spark, {"silver": path}, "default")
    table = read_table(spark, table_name("silver", "default"))
    directory = F.regexp_extract("_metadata.file_path", "/([^/]+)/[^/]+$", 1)
    return table.select("*", directory.alias("directory"))


def _colocated(t: SampleLayers, operator: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """Store Bronze and the faulty Silver in buckets by id, and join them where they lie."""
    names = []
    for layer, df in (("bronze", t.bronze), ("silver", t.silver)):
        path = scratch_path(t.spark, "buckets")
        names.append(f"default.{layer}_{path.rpartition('-')[2]}")
        write_bucketed(df, names[-1], path, buckets=8)
    return operator(*read_colocated(t.spark, *names))


def _discrepancy_by_digests(t: SampleLayers) -> DataFrame:
    """Store the digests of Bronze and the faulty Silver, and join what differs."""
    layers = _stored(t.bronze, schemas.BRONZE), _stored(t.silver, schemas.SILVER)
    paths = [scratch_path(t.spark, "digests") for _ in layers]
    for df, path, distinct in zip(layers, paths, (True, False)):
        store_digests(df, path, ["transaction_id", "amount"], distinct=distinct)
    return amount_discrepancy_by_digests(*layers, *paths)


def _gold_by_digests(t: SampleLayers) -> DataFrame:
    """Compare the faulty Gold with Silver twice; the second time only dates that differ."""
    silver, gold = _stored(t.silver, schemas.SILVER), _stored(t.gold, schemas.GOLD)
    paths = [scratch_path(t.spark, "digests") for _ in range(3)]
    store_digests(
        silver, paths[0], ["transaction_id", "transaction_type", "amount", "amount_valid"]
    )
    store_digests(gold, paths[1], ["transaction_type", "daily_total", "record_count"])
    silver_gold_by_digests(silver, gold, *paths)
    return silver_gold_by_digests(silver, gold, *paths)


def _bitmaps(t: SampleLayers, *layers: DataFrame) -> list[DataFrame]:
    """Number the ids of layers and store their bitmaps."""
    dictionary, found = scratch_path(t.spark, "ids"), []
    for df in layers:
        path = scratch_path(t.spark, "bitmaps")
        store_bitmaps(df, path, dictionary)
        found.append(read_bitmaps(t.spark, path))
    return found


def _percentile_ranks(t: SampleLayers) -> DataFrame:
    """Store a sketch for each date and type, merge all, and test each value's rank."""
    path = scratch_path(t.spark, "sketches")
    write_layer(sketches.daily_sketches(t.silver_clean), path)
    merged = sketches.merged_percentiles(read_layer(t.spark, path))
    off = sketches.rank_errors(t.silver_clean, merged)
    within = [(F.col(n) <= sketches.RANK_ERROR).alias(n) for n in sketches.NAMES]
    return off.select("transaction_type", "amounts", *within)


def _running(values: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Store running totals with a lost and a wrong date, correct these dates, and read all."""
    spark, path = values.sparkSession, scratch_path(values.sparkSession, "running")
    wrong = F.when(F.col("booked_date") == "2024-01-09", F.col("value") + 1).otherwise(F.col("value"))
    lost = values.where("booked_date <> DATE'2024-01-20'")
    carries.store_running(lost.withColumn("value", wrong.cast("decimal(38,2)")), path, by)
    carries.store_running(values, path, by, dates=["2024-01-09", "2024-01-20"])
    return carries.read_running(spark, path, by)


def _incremental(t: SampleLayers) -> LayerPaths:
    """Build all layers by two dated runs, each over every other date."""
    paths = LayerPaths(scratch_path(t.spark, "layers"))
    days = sorted(str(r[0]) for r in t.bronze.select("booked_date").distinct().collect())
    for dates in (days[::2], days[1::2]):
        jobs.run_bronze(t.raw, paths, dates)
        jobs.run_gold(t.spark, paths, jobs.run_silver(t.spark, paths, dates))
    return paths


def _published(t: SampleLayers) -> DataFrame:
    """Publish Silver with a wrong and a needless date, correct both at once, compact, and read it."""
    spark, root = t.spark, scratch_path(t.spark, "published")
    silver, wrong = t.silver_clean, F.col("booked_date") == "2024-01-09"
    needless = silver.where(wrong).withColumn("booked_date", F.lit("1999-12-31").cast("date"))
    publish_layer(silver.where(~wrong | F.col("booked_date").isNull()).unionByName(needless), root)
    publish_layer(silver.where(wrong), root, dates=["1999-12-31"], clear=True)
    compact_published(spark, root, schemas.SILVER)
    return read_published(spark, root, schemas.SILVER)


def _arrived(t: SampleLayers) -> DataFrame:
    """Take a folder of raw files as it grows by thirds, and once more unchanged; Bronze of what came."""
    spark, root = t.spark, scratch_path(t.spark, "arrivals")
    store, schema = ArrivalStore(f"{root}/store"), raw_schema(t.raw.columns)
    third = F.pmod(F.crc32(F.coalesce("transaction_id", F.lit(""))), F.lit(3))
    for part in range(3):
        t.raw.where(third == part).write.mode("append").json(f"{root}/in")
        take_new_files(spark, f"{root}/in", store, schema)
    take_new_files(spark, f"{root}/in", store, schema)
    arrivals = read_arrivals(spark, store, schema)
    return jobs.ingest_bronze(arrivals.where("malformed_text IS NULL").select(*schema.fieldNames()))


def _quality_report(t: SampleLayers) -> DataFrame:
    """Silver and Gold serve several rules each, so they are stored once."""
    return quality_report(
        t.bronze, _stored(t.silver, schemas.SILVER), _stored(t.gold, schemas.GOLD)
    )


def _compacted(bronze: DataFrame) -> DataFrame:
    """Store Bronze in scattered files, compact it in place and return what is there then."""
    spark = bronze.sparkSession
    path = scratch_path(spark, "layer")
    bronze.repartition(8).write.partitionBy("booked_date").parquet(path)
    compact_layer(spark, path, schemas.BRONZE)
    return read_layer(spark, path, schemas.BRONZE)


def _clustered(bronze: DataFrame) -> DataFrame:
    """Store Bronze, rewrite it along the curve and return what is there then."""
    spark = bronze.sparkSession
    path = scratch_path(spark, "layer")
    write_layer(bronze, path)
    cluster_layer(spark, path, schemas.BRONZE, target_bytes=64 * 1024)
    return read_layer(spark, path, schemas.BRONZE)


QUERIES: dict[str, Callable[[SampleLayers], DataFrame]] = {
    "bronze_partitions": lambda t: _partition_dirs(t.bronze),
    "silver_partitions": lambda t: _partition_dirs(t.silver_clean),
    "gold_partitions": lambda t: _partition_dirs(t.gold_clean),
    "bronze_sample": lambda t: audits.bronze_sample(t.bronze),
    "bronze_volume_by_day": lambda t: audits.bronze_volume_by_day(t.bronze),
    "bronze_type_distribution": lambda t: audits.bronze_type_distribution(t.bronze),
    "bronze_null_audit": lambda t: audits.bronze_null_audit(t.bronze),
    "bronze_duplicates": lambda t: audits.bronze_duplicates(t.bronze),
    "bronze_cash_flow": lambda t: audits.bronze_cash_flow(t.bronze),
    "silver_sample": lambda t: audits.silver_sample(t.silver_clean),
    "silver_validity_by_day": lambda t: audits.silver_validity_by_day(t.silver_clean),
    "silver_type_breakdown": lambda t: audits.silver_type_breakdown(t.silver_clean),
    "silver_flagged": lambda t: audits.silver_flagged(t.silver_clean),
    "silver_running_balance": lambda t: analytics.silver_running_balance(t.silver_clean),
    "silver_percentiles": lambda t: silver_percentiles(t.silver_clean),
    "silver_percentiles_approx": lambda t: silver_percentiles(t.silver_clean, accuracy=1_000_000),
    "recon_layer_counts": lambda t: reconcile.recon_layer_counts(t.bronze, t.silver),
    "recon_missing_in_silver": lambda t: reconcile.recon_missing_in_silver(t.bronze, t.silver),
    "recon_amount_discrepancy": lambda t: reconcile.recon_amount_discrepancy(t.bronze, t.silver),
    "recon_type_mismatch": lambda t: reconcile.recon_type_mismatch(t.bronze, t.silver),
    "recon_dates_bronze_not_silver": lambda t: reconcile.recon_dates_bronze_not_silver(
        t.bronze, t.silver
    ),
    "gold_sample": lambda t: audits.gold_sample(t.gold_clean),
    "gold_by_day": lambda t: analytics.gold_by_day(t.gold_clean),
    "gold_by_type": lambda t: analytics.gold_by_type(t.gold_clean),
    "recon_silver_gold": lambda t: reconcile.recon_silver_gold(t.silver, t.gold),
    "recon_dates_silver_not_gold": lambda t: reconcile.recon_dates_silver_not_gold(
        t.silver, t.gold
    ),
    "gold_cumulative": lambda t: analytics.gold_cumulative(t.gold_clean),
    "gold_weekly": lambda t: analytics.gold_weekly(t.gold_clean),
    "silver_daily_totals": lambda t: analytics.silver_daily_totals(t.silver_clean),
    "silver_weekly": lambda t: analytics.silver_weekly(t.silver_clean),
    "silver_top3_per_day": lambda t: analytics.silver_top3_per_day(t.silver_clean),
    "silver_liquidity_ratio": lambda t: analytics.silver_liquidity_ratio(t.silver_clean),
    "silver_drift": lambda t: drift(value_counts(t.silver_clean)),
    "silver_day_over_day": lambda t: analytics.silver_day_over_day(t.silver_clean),
    "medallion_journey": lambda t: reconcile.medallion_journey(t.bronze, t.silver),
    "lifetime_balance": lambda t: analytics.lifetime_balance(t.silver_clean),
    "daily_pivot": lambda t: analytics.daily_pivot(t.silver_clean),
    "silver_coverage": lambda t: reconcile.silver_coverage(t.bronze, t.silver),
    "silver_coverage_by_bronze_date": lambda t: reconcile.silver_coverage(
        t.bronze, t.silver, by="bronze"
    ),
    "freshness": lambda t: reconcile.freshness(t.bronze, t.silver, t.gold),
    "matched_by_type": lambda t: reconcile.matched_by_type(t.bronze, t.silver),
    "matched_by_type_where": lambda t: reconcile.matched_by_type(
        t.bronze, t.silver, where="amount > 0"
    ),
    "bronze_ingest": lambda t: jobs.ingest_bronze(t.raw),
    "silver_clean": lambda t: t.silver_clean,
    "silver_rejects": lambda t: jobs.rejected_rows(t.bronze),
    "gold_build": lambda t: t.gold_clean,
    "layer_round_trip": lambda t: _stored(t.silver_clean, schemas.SILVER),
    "silver_by_name": _by_name,
    "arrivals_bronze": _arrived,
    "published_corrections": _published,
    "colocated_layer_counts": lambda t: _colocated(t, reconcile.recon_layer_counts),
    "colocated_missing_in_silver": lambda t: _colocated(t, reconcile.recon_missing_in_silver),
    "colocated_amount_discrepancy": lambda t: _colocated(t, reconcile.recon_amount_discrepancy),
    "colocated_type_mismatch": lambda t: _colocated(t, reconcile.recon_type_mismatch),
    "colocated_matched_by_type": lambda t: _colocated(t, reconcile.matched_by_type),
    "digest_amount_discrepancy": _discrepancy_by_digests,
    "digest_silver_gold": _gold_by_digests,
    "bitmap_layer_counts": lambda t: layer_counts_by_bitmaps(*_bitmaps(t, t.bronze, t.silver)),
    "bitmap_weekly_ids": lambda t: distinct_ids(
        *_bitmaps(t, t.bronze), week_start("booked_date").alias("week_start")
    ),
    "merged_percentile_ranks": _percentile_ranks,
    "carried_running_balance": lambda t: carries.running_balance(
        _running(carries.daily_net(t.silver_clean))
    ),
    "carried_day_over_day": lambda t: carries.day_over_day(
        _running(carries.daily_net(t.silver_clean))
    ),
    "carried_gold_cumulative": lambda t: carries.cumulative(
        _running(carries.daily_gold(t.gold_clean), ("transaction_type",))
    ),
    "silver_incremental": lambda t: read_layer(t.spark, _incremental(t).silver, schemas.SILVER),
    "gold_incremental": lambda t: read_layer(t.spark, _incremental(t).gold, schemas.GOLD),
    "compaction": lambda t: _compacted(t.bronze),
    "clustered_layer": lambda t: _clustered(t.bronze),
    "quality_report": _quality_report,
}


def with_double_money(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the form in which the comparison takes them."""
    if not any(isinstance(f.dataType, T.DecimalType) for f in df.schema):
        return df
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_double_money(QUERIES[name](SampleLayers(spark, sf_dir)))
