"""Layers stored so that joins by id need no shuffle: bucketed tables.

A bucketed layer keeps its date directories; below them rows lie in files by a hash of the id. Two layers
with the same number of buckets are joined, and each grouped by id, bucket by bucket where they lie.

A bucket is one task, so a hot id makes one slow task. ``read_colocated`` looks at the sizes of the
buckets, from a listing, before it relies on them: a layer with a bucket far above the mean is read as
plain files instead, and joins shuffle and let adaptive execution split what is skewed.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstrata.columns import DEFAULT, Columns
from ledgerstrata.sources.layers import only_dates, read_layer

# A bucket may have so many times the mean bytes of a bucket, or this many bytes.
MOST_TIMES_MEAN, ALWAYS_FINE = 4.0, 256 << 20


def write_bucketed(
    df: DataFrame, name: str, path: str, buckets: int, c: Columns = DEFAULT
) -> None:
    """Create a table over ``path`` by date and bucket of id, or replace it with all its rows.

    Rows are shuffled once, by id, so that there is one file for each date and bucket.
    """
    ordered = [n for n in df.columns if n != c.date] + [c.date]
    (
        df.select(*ordered)
        .repartition(buckets, c.id)
        .write.partitionBy(c.date)
        .bucketBy(buckets, c.id)
        .sortBy(c.id)
        .mode("overwrite")
        .option("path", path)
        .saveAsTable(name)
    )


def replace_dates(df: DataFrame, name: str, dates: Iterable[date | str], c: Columns = DEFAULT) -> None:
    """Replace the rows of some dates of a bucketed table; dates that get no rows are emptied."""
    spark = df.sparkSession
    dates = [str(d) for d in dates]
    table = spark.table(name)
    buckets = bucket_count(spark, name)
    rows = only_dates(df, dates, c).select(*table.columns)
    held = {str(r[0]) for r in rows.select(c.date).distinct().collect()}
    rows = rows.repartition(buckets, c.id)
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        rows.write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(setting, before)
    for day in sorted(set(dates) - held):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({c.date} = DATE'{day}') PURGE")
        _delete_date(spark, name, day, c)
    spark.catalog.refreshTable(name)


def _delete_date(spark: SparkSession, name: str, day: str, c: Columns) -> None:
    """Files of a date of an external table stay when its partition is dropped."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{table_path(spark, name)}/{c.date}={day}")
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def _described(spark: SparkSession, name: str) -> dict[str, str]:
    return {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}


def table_path(spark: SparkSession, name: str) -> str:
    return _described(spark, name)["Location"]


def bucket_count(spark: SparkSession, name: str) -> int:
    return int(_described(spark, name)["Num Buckets"])


def bucket_bytes(spark: SparkSession, path: str) -> DataFrame:
    """Bytes of each bucket over all dates, from a directory listing: bucket, bytes.

    The number of its bucket stands in the name of each file.
    """
    number = F.regexp_extract("path", r"_(\d+)(?:\.c\d+)?\.[^/]*$", 1).cast("int")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return files.groupBy(number.alias("bucket")).agg(F.sum("length").alias("bytes"))


def is_balanced(spark: SparkSession, name: str) -> bool:
    """Whether no bucket is so large that the shuffle it saves would cost less."""
    sizes = bucket_bytes(spark, table_path(spark, name))
    most, total = sizes.agg(F.max("bytes"), F.sum("bytes")).first()
    mean = (total or 0) / bucket_count(spark, name)
    return (most or 0) <= max(MOST_TIMES_MEAN * mean, ALWAYS_FINE)


def read_colocated(spark: SparkSession, *names: str, c: Columns = DEFAULT) -> list[DataFrame]:
    """Bucketed tables for a join by id; as plain files if one of them has a hot bucket."""
    if all(is_balanced(spark, name) for name in names):
        return [spark.table(name) for name in names]
    return [read_layer(spark, table_path(spark, name), spark.table(name).schema, c=c) for name in names]
