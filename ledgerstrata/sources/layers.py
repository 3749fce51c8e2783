"""Reading, writing and listing of date-partitioned Parquet layers."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstrata.columns import DEFAULT, Columns
from ledgerstrata.functions.exprs import asc


def read_layer(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    dates: Iterable[date | str] | None = None,
    c: Columns = DEFAULT,
) -> DataFrame:
    """Layer files below ``path`` (Hive layout). ``dates`` prunes partitions before any file is read.

    A glob such as ``root/**/*.parquet`` is not needed: name the root, and the partition column is
    found from the directories.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return only_dates(reader.parquet(path), dates, c)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Registered table, e.g. ``transactions_db.bronze_transactions``."""
    return spark.table(name)


def only_dates(df: DataFrame, dates: Iterable[date | str] | None, c: Columns = DEFAULT) -> DataFrame:
    if dates is None:
        return df
    return df.where(F.col(c.date).isin([F.lit(str(d)).cast("date") for d in dates]))


def write_layer(
    df: DataFrame,
    path: str,
    c: Columns = DEFAULT,
    dates: Iterable[date | str] | None = None,
    clear: bool = False,
) -> None:
    """Write one directory per date, replacing the dates present in ``df``.

    With ``clear``, the other dates are emptied as well: those among ``dates``, or all without them.
    That happens after the write has succeeded, so a failed write removes nothing.

    The rebalance hint gathers each date into files near
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes``: small dates share a task, and a date that
    holds a large part of the rows is split over many.
    """
    spark = df.sparkSession
    before = _date_files(spark, path, c, dates) if clear else {}
    write_as_partitioned(df.hint("rebalance", c.date), path, c)
    after = _date_files(spark, path, c, dates) if clear else {}
    for directory, files in before.items():
        # Replaced dates hold new files; one that still holds its old files got no rows.
        if files & after.get(directory, set()):
            _delete(spark, directory)


def file_system(spark: SparkSession, path: str):
    """Hadoop file system of a path, and the path."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _date_files(
    spark: SparkSession, path: str, c: Columns, dates: Iterable[date | str] | None
) -> dict[str, set[str]]:
    """Data files by date directory, from listings of the given dates, or of all of them."""
    fs, root = file_system(spark, path)
    if not fs.exists(root):
        return {}
    if dates is None:
        found = [s.getPath() for s in fs.listStatus(root) if s.isDirectory()]
        found = [p for p in found if p.getName().startswith(f"{c.date}=")]
    else:
        path_of = spark._jvm.org.apache.hadoop.fs.Path
        found = [path_of(root, f"{c.date}={d}") for d in dates]
        found = [p for p in found if fs.exists(p)]
    return {
        str(p): {str(s.getPath()) for s in fs.listStatus(p) if s.getPath().getName()[0] not in "._"}
        for p in found
    }


def _delete(spark: SparkSession, path: str) -> None:
    fs, where = file_system(spark, path)
    fs.delete(where, True)


def write_as_partitioned(df: DataFrame, path: str, c: Columns = DEFAULT) -> None:
    """As ``write_layer``, with one file per task and date as ``df`` is partitioned already."""
    ordered = [n for n in df.columns if n != c.date] + [c.date]
    (
        df.select(*ordered)
        .write.partitionBy(c.date)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(path)
    )


def file_sizes(spark: SparkSession, path: str, c: Columns = DEFAULT) -> DataFrame:
    """One row per data file from a directory listing; no file is opened."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return listing.select("path", "length", F.col(c.date).cast("date").alias(c.date))


def stored_files(spark: SparkSession, path: str, c: Columns = DEFAULT) -> DataFrame:
    """Every data file of a stored layer with its date, from a directory listing."""
    return (
        file_sizes(spark, path, c)
        .select(F.col("path").alias("file_path"), F.col(c.date))
        .orderBy(*asc(c.date, "file_path"))
    )


def layer_files(df: DataFrame, c: Columns = DEFAULT) -> DataFrame:
    """As ``stored_files``, for a DataFrame that comes straight from a reader or a table.

    Reads no data column, but opens the files; where the path is known, list it instead.
    """
    return (
        df.select(F.col("_metadata.file_path").alias("file_path"), F.col(c.date))
        .distinct()
        .orderBy(*asc(c.date, "file_path"))
    )


def layer_dates(spark: SparkSession, path: str, c: Columns = DEFAULT) -> DataFrame:
    """Dates of a stored layer from a directory listing; rows without date give NULL.

    Stands in for the layer where only its dates matter: freshness and date gaps.
    """
    return file_sizes(spark, path, c).select(c.date).distinct()


def layer_exists(spark: SparkSession, path: str) -> bool:
    """Whether a stored layer has any data file."""
    fs, root = file_system(spark, path)
    return fs.exists(root) and any(
        s.isDirectory() and s.getPath().getName()[0] not in "._" for s in fs.listStatus(root)
    )
