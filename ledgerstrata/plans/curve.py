"""Files in the order of a space-filling curve over id and time, so that look-ups skip most of them.

Id and time are cut into equally filled ranges, whose numbers are interleaved bit by bit (a Z-curve).
Rows near one another on it share files, so each file spans few ids and little time, and a filter on
either one drops files and row groups by the least and largest values in their footers.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstrata.columns import DEFAULT, Columns
from ledgerstrata.plans.compaction import TARGET_FILE_BYTES
from ledgerstrata.sources.layers import file_sizes, only_dates, read_layer, write_as_partitioned

BITS = 8
# Rows whose values tell where ranges begin, about. They shape files, never results.
SAMPLE_ROWS = 20_000


def range_starts(df: DataFrame, names: list[str], bits: int = BITS, rows: int = SAMPLE_ROWS) -> dict[str, list]:
    """For each column the least values of its ranges but the first, from about ``rows`` sampled rows.

    There are 2^bits ranges, fewer if a column has fewer values. Only the sample reaches the driver.
    """
    total = df.count()
    sample = df.select(*names)
    if total > rows:
        sample = sample.sample(fraction=rows / total, seed=1)
    found = sample.collect()
    starts = {}
    for name in names:
        values = sorted(r[name] for r in found if r[name] is not None)
        cuts = {values[len(values) * i >> bits] for i in range(1, 1 << bits)} if values else set()
        starts[name] = sorted(cuts)
    return starts


def range_number(value: Column, starts: list, kind: T.DataType, bits: int = BITS) -> Column:
    """Number of starts that are not above ``value``, by halving; 0 for NULL."""
    if not starts:
        return F.lit(0)
    bounds = F.array(*[F.lit(s).cast(kind) for s in starts])
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(bits))])
    return F.aggregate(
        steps,
        F.lit(0),
        lambda n, step: F.when(value >= F.get(bounds, n + step - 1), n + step).otherwise(n),
    )


def curve_place(numbers: list[Column], bits: int = BITS) -> Column:
    """Bits of all numbers in turn, the highest first."""
    place = F.lit(0).cast("long")
    for b in reversed(range(bits)):
        for number in numbers:
            place = F.shiftleft(place, 1).bitwiseOR(F.shiftright(number, b).bitwiseAND(F.lit(1)))
    return place


def along_curve(df: DataFrame, files: int, c: Columns = DEFAULT, bits: int = BITS) -> DataFrame:
    """Rows in about ``files`` equal ranges by date and place on the curve, each sorted.

    Id and time follow in the order, so rows of a hot id are spread over ranges by their time.
    """
    starts = range_starts(df, [c.id, c.booked_at], bits)
    place = curve_place(
        [range_number(F.col(n), starts[n], df.schema[n].dataType, bits) for n in (c.id, c.booked_at)], bits
    )
    order = [F.col(c.date), F.col("_place"), F.col(c.id), F.col(c.booked_at)]
    return (
        df.withColumn("_place", place)
        .repartitionByRange(files, *order)
        .sortWithinPartitions(*order)
        .drop("_place")
    )


def cluster_layer(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    target_bytes: int = TARGET_FILE_BYTES,
    dates: Iterable[date | str] | None = None,
    c: Columns = DEFAULT,
) -> int:
    """Rewrite dates of a layer along the curve in files of about ``target_bytes``; their number.

    One shuffle by range, of the given dates or of all: give ``dates`` to take a large layer in parts.
    Directories are replaced after all files are complete, as in ``compact_layer``; an empty layer
    is left as it is.
    """
    dates = None if dates is None else [str(d) for d in dates]
    size = only_dates(file_sizes(spark, path, c), dates, c).agg(F.sum("length")).first()[0]
    if not size:
        return 0
    files = -(-size // target_bytes)
    write_as_partitioned(along_curve(read_layer(spark, path, schema, dates, c), files, c), path, c)
    return files
