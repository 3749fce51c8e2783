"""Raw files that arrive in a folder, each taken once, and the dated runs that follow.

A file stream with the trigger "available now" is the ledger: its checkpoint holds the files taken, so a
second run takes new ones only and a repeated run none, also after a run that was lost half way. Rows
are appended, with the file they come from, to a store in folders by ``taken`` (the time of their batch)
and ``day`` (the date of their booking); a batch that is tried again does not double them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstrata.columns import DEFAULT, Columns
from ledgerstrata.plans.jobs import LayerPaths, run_bronze, run_gold, run_silver
from ledgerstrata.sources import schemas
from ledgerstrata.sources.layers import file_system

FILES_PER_BATCH = 10_000
# What a store holds beside the raw columns.
_ORIGIN = "path string, length long, modified timestamp"
_TEXT = "malformed_text"


@dataclass(frozen=True)
class ArrivalStore:
    """Where arrivals are kept: ``rows``, the ledger of the stream, and marks of finished runs."""

    root: str

    @property
    def rows(self) -> str:
        return f"{self.root}/rows"

    @property
    def ledger(self) -> str:
        return f"{self.root}/ledger"

    @property
    def finished(self) -> str:
        return f"{self.root}/finished"


def raw_schema(names: list[str]) -> T.StructType:
    """Text columns of these names."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _day(raw: DataFrame, c: Columns) -> Column:
    """The date under which ``ingest_bronze`` files a row."""
    if c.date in raw.columns:
        return F.col(c.date).try_cast("date")
    return F.col(c.booked_at).try_cast("timestamp_ntz").cast("date")


def take_new_files(
    spark: SparkSession,
    folder: str,
    store: ArrivalStore,
    schema: T.StructType,
    file_format: str = "json",
    options: dict[str, str] | None = None,
    files_per_batch: int = FILES_PER_BATCH,
    c: Columns = DEFAULT,
) -> None:
    """Append the rows of files in ``folder`` that were not taken before.

    ``schema`` holds text columns. A file is known by its path: write files once, under new names,
    and move them into the folder complete. Files are taken in batches of ``files_per_batch``, so a
    first run over a very large folder does not become one job. A line that cannot be read as
    a row is kept as ``malformed_text``. One run at a time may use a store; an empty folder is fine,
    a missing one is an error.
    """
    reader = (
        spark.readStream.format(file_format)
        .schema(T.StructType(schema.fields + [T.StructField(_TEXT, T.StringType())]))
        .options(**(options or {}))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _TEXT)
        .option("maxFilesPerTrigger", files_per_batch)
    )
    raw = reader.load(folder)
    stamped = raw.select(
        "*",
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("length"),
        F.col("_metadata.file_modification_time").alias("modified"),
        # One value per batch, kept in the ledger: a batch that is tried again has the same.
        F.date_format(F.current_timestamp(), "'t'yyyyMMddHHmmssSSS").alias("taken"),
        _day(raw, c).alias("day"),
    )
    run = (
        stamped.writeStream.format("parquet")
        .partitionBy("taken", "day")
        .option("checkpointLocation", store.ledger)
        .trigger(availableNow=True)
        .start(store.rows)
    )
    run.awaitTermination()


def read_arrivals(spark: SparkSession, store: ArrivalStore, schema: T.StructType) -> DataFrame:
    """Rows taken so far with ``path``, ``length``, ``modified``, ``malformed_text``, ``taken`` and
    ``day``; conditions on the last two prune folders. Files of unfinished batches are not seen."""
    fields = T.StructType.fromDDL(f"{_TEXT} string, {_ORIGIN}, taken string, day date").fields
    whole = T.StructType(schema.fields + fields)
    fs, where = file_system(spark, f"{store.rows}/_spark_metadata")
    if not fs.exists(where):
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).parquet(store.rows)


def file_ledger(arrivals: DataFrame) -> DataFrame:
    """One row per file that held rows: ``path``, ``length``, ``modified``, ``taken``, ``n_rows``,
    ``n_malformed``."""
    return arrivals.groupBy("path", "length", "modified", "taken").agg(
        F.count("*").alias("n_rows"), F.count(_TEXT).alias("n_malformed")
    )


def rejected_text(arrivals: DataFrame, c: Columns = DEFAULT) -> DataFrame:
    """Rows whose text could not be read, as ``path``, ``taken``, ``reason`` and ``text``.

    The reason is ``malformed`` for a line that is no row, and else the first of ``bad_time``,
    ``bad_amount`` and ``bad_date`` that has text which does not parse. Rows with a bad value also enter
    Bronze, with NULL in its place.
    """
    checks = [(c.booked_at, "timestamp_ntz", "bad_time"), (c.amount, schemas.MONEY, "bad_amount")]
    if c.date in arrivals.columns:
        checks.append((c.date, "date", "bad_date"))
    reason = F.when(F.col(_TEXT).isNotNull(), F.lit("malformed"))
    text = F.when(F.col(_TEXT).isNotNull(), F.col(_TEXT))
    for name, kind, fault in checks:
        bad = F.col(name).isNotNull() & (F.trim(name) != "") & F.col(name).try_cast(kind).isNull()
        reason, text = reason.when(bad, F.lit(fault)), text.when(bad, F.col(name))
    found = arrivals.select("path", "taken", reason.alias("reason"), text.alias("text"))
    return found.where("reason IS NOT NULL")


def _finished(spark: SparkSession, store: ArrivalStore) -> str:
    """The last batch whose dates went through all layers; empty before the first."""
    fs, where = file_system(spark, store.finished)
    if not fs.exists(where):
        return ""
    return max((s.getPath().getName() for s in fs.listStatus(where)), default="")


def run_arrivals(
    spark: SparkSession,
    folder: str,
    store: ArrivalStore,
    paths: LayerPaths,
    schema: T.StructType,
    file_format: str = "json",
    options: dict[str, str] | None = None,
    files_per_batch: int = FILES_PER_BATCH,
) -> list[str]:
    """Take new files and bring the dates of their rows up to date in all layers; returns these dates.

    Bronze of a date is made again from all that ever arrived for it, so a run that is lost at any
    point is made good by the next: batches count as finished only when Gold has been written. Rows
    without date go to the quarantine with the run that takes them, or, if no row of a run has a
    date, with the next one that has any.
    """
    take_new_files(spark, folder, store, schema, file_format, options, files_per_batch)
    arrivals = read_arrivals(spark, store, schema)
    new = F.col("taken") > _finished(spark, store)
    # One row per batch and date, from the names of folders.
    found = arrivals.where(new).select("taken", "day").distinct().collect()
    dates = sorted({str(r.day) for r in found if r.day is not None})
    if not dates:
        return []
    wanted = F.col("day").isin([F.lit(d).cast("date") for d in dates]) | (F.col("day").isNull() & new)
    rows = arrivals.where(wanted).where(F.col(_TEXT).isNull())
    run_bronze(rows.select(*schema.fieldNames()), paths, dates)
    run_gold(spark, paths, run_silver(spark, paths, dates))
    fs, mark = file_system(spark, f"{store.finished}/{max(r.taken for r in found)}")
    fs.mkdirs(mark)
    return dates
