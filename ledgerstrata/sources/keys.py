"""Stored sets of ids, and joins with them that drop foreign rows where they are scanned.

The filter is Spark's own runtime Bloom filter. By default it acts only on small sets and very large scans;
``runtime_filter`` sets its limits by the size of the set, for the plans made and run inside it.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstrata.sources.scratch import scratch_path

# With ten bits for each id about one foreign id in a hundred passes. A filter has 64 MB at most, as
# every task holds one; a set beyond 50 million ids gets fewer bits each and lets more pass.
BITS_PER_KEY, MOST_BITS = 10, 2**29

_PREFIX = "spark.sql.optimizer.runtime.bloomFilter."


@dataclass(frozen=True)
class StoredKeys:
    """Rows with ids in shared scratch storage, as many as ``count``; no id is NULL."""

    rows: DataFrame
    column: str
    count: int

    def those_in(self, df: DataFrame) -> DataFrame:
        """Rows of ``df`` whose id is in the set.

        Inside ``runtime_filter`` the rows are filtered at their scan, unless the set is so small that
        Spark broadcasts it, which shuffles nothing either.
        """
        # True of every id; the optimizer builds runtime filters from filtered tables only.
        chosen = self.rows.select(self.column).where(F.col(self.column) >= "")
        return df.join(chosen, self.column, "left_semi")


def store_rows_with_keys(rows: DataFrame, column: str) -> StoredKeys:
    """Write the rows whose id (text) is not NULL; ids may repeat."""
    spark = rows.sparkSession
    path = scratch_path(spark, "keys")
    rows.where(F.col(column).isNotNull()).write.parquet(path)
    stored = spark.read.parquet(path)
    return StoredKeys(stored, column, stored.count())


def store_keys(keys: DataFrame, column: str) -> StoredKeys:
    """Write the distinct non-NULL ids of a column; one job that shuffles them."""
    return store_rows_with_keys(keys.select(column).distinct(), column)


@contextmanager
def runtime_filter(spark: SparkSession, keys: StoredKeys, bits: int | None = None) -> Iterator[None]:
    """Let Spark build Bloom filters from a set of this size; ``bits`` of the filter may be given.

    Whatever its size, a filter only saves work: the join that follows decides. Plans are made when an
    action runs, so the action has to run inside.
    """
    bits = min(MOST_BITS, max(1024, BITS_PER_KEY * keys.count)) if bits is None else bits
    settings = {
        f"{_PREFIX}enabled": "true",
        f"{_PREFIX}creationSideThreshold": "1000t",
        f"{_PREFIX}applicationSideScanSizeThreshold": "0",
        f"{_PREFIX}expectedNumItems": str(max(1, keys.count)),
        f"{_PREFIX}maxNumItems": str(max(1, keys.count)),
        f"{_PREFIX}numBits": str(bits),
        f"{_PREFIX}maxNumBits": str(bits),
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
