"""Fewer, larger files per date; the rows stay the same."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstrata.columns import DEFAULT, Columns
from ledgerstrata.sources.layers import file_sizes, only_dates, read_layer, write_layer
from ledgerstrata.sources.published import publish_layer, published_files, read_published

TARGET_FILE_BYTES = 128 * 1024 * 1024


def scattered_dates(
    spark: SparkSession,
    path: str,
    target_bytes: int = TARGET_FILE_BYTES,
    dates: Iterable[date | str] | None = None,
    c: Columns = DEFAULT,
) -> DataFrame:
    """Dates with at least twice as many files as their size needs, and that number as ``wanted``.

    Rows without date stay in the files they have.
    """
    return _scattered(only_dates(file_sizes(spark, path, c), dates, c), target_bytes, c)


def _scattered(files: DataFrame, target_bytes: int, c: Columns) -> DataFrame:
    return (
        files.where(F.col(c.date).isNotNull())
        .groupBy(c.date)
        .agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
        .withColumn("wanted", F.ceil(F.col("bytes") / target_bytes))
        .where(F.col("files") >= 2 * F.col("wanted"))
        .select(c.date, "files", "wanted")
    )


def compact_layer(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    target_bytes: int = TARGET_FILE_BYTES,
    dates: Iterable[date | str] | None = None,
    c: Columns = DEFAULT,
) -> bool:
    """Rewrite in place the dates whose files are too many; True if any were.

    The rebalance hint deals the rows of each date to files near ``target_bytes``, measured as the rows
    are shuffled, however they were spread before. Only directories of rewritten dates are
    replaced, and not before every new file is complete, so a lost executor leaves the layer as it
    was; if the driver is lost while it swaps directories, run it again for the same ``dates`` from
    Bronze. One run shuffles all it rewrites: give ``dates`` to take a very large layer in parts.
    """
    todo = scattered_dates(spark, path, target_bytes, dates, c)
    found = [r[0] for r in todo.select(c.date).collect()]  # one row per calendar date
    if not found:
        return False
    layer = read_layer(spark, path, schema, found, c)
    with _advisory_size(spark, target_bytes):
        write_layer(layer, path, c)
    return True


def compact_published(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    target_bytes: int = TARGET_FILE_BYTES,
    dates: Iterable[date | str] | None = None,
    c: Columns = DEFAULT,
) -> bool:
    """As ``compact_layer``, for a published layer: readers see the old files or the new ones.

    A driver lost at any moment leaves the layer as it was, and nothing has to be run again.
    """
    todo = _scattered(only_dates(published_files(spark, root, c), dates, c), target_bytes, c)
    found = [r[0] for r in todo.select(c.date).collect()]  # one row per calendar date
    if not found:
        return False
    with _advisory_size(spark, target_bytes):
        publish_layer(read_published(spark, root, schema, found, c=c), root, c)
    return True


@contextmanager
def _advisory_size(spark: SparkSession, size: int) -> Iterator[None]:
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.set(key, old)
