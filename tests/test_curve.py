"""Layers along the curve: the same rows, and look-ups that skip most row groups."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerstrata.plans.curve import cluster_layer, curve_place, range_number, range_starts
from ledgerstrata.sources import schemas
from ledgerstrata.sources.layers import read_layer

from .conftest import rows


def groups_that_may_hold(path, column, value):
    """Row groups whose least and largest values of a column do not exclude a value, and all."""
    may = total = 0
    for file in glob.glob(f"{path}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(file).metadata
        at = [meta.schema.column(i).name for i in range(meta.num_columns)].index(column)
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            may += stats.min <= value <= stats.max
            total += 1
    return may, total


@pytest.fixture(scope="module")
def large(spark, tmp_path_factory):
    """One date of 200,000 rows in 64 files as they came, a third of them of one id."""
    path = str(tmp_path_factory.mktemp("curve") / "layer")
    ids = F.when(F.col("id") % 3 == 0, F.lit("T00000hot")).otherwise(
        F.concat(F.lit("T"), F.lpad((F.xxhash64("id") % 1_000_000 + 1_000_000).cast("string"), 9, "0"))
    )
    df = spark.range(0, 200_000, 1, 64).select(
        ids.alias("transaction_id"),
        F.timestamp_seconds(1_704_067_200 + F.pmod(F.hash("id"), F.lit(86_400))).cast("timestamp_ntz").alias("booked_at"),
        (F.col("id") % 1000).cast(schemas.MONEY).alias("amount"),
        F.lit("fee").alias("transaction_type"),
        F.lit("2024-01-01").cast("date").alias("booked_date"),
    )
    df.write.partitionBy("booked_date").parquet(path)
    return path


def test_look_ups_read_a_fifth_of_the_row_groups_at_most(spark, large):
    read = lambda: read_layer(spark, large, schemas.BRONZE)
    total = lambda: read().agg(F.count("*"), F.sum(F.xxhash64("*").cast("decimal(38,0)"))).first()
    before, content = groups_that_may_hold(large, "transaction_id", "T001234567"), total()
    assert before == (64, 64)
    size = sum(len(open(f, "rb").read()) for f in glob.glob(f"{large}/**/*.parquet", recursive=True))
    assert cluster_layer(spark, large, schemas.BRONZE, target_bytes=size // 64) >= 64
    assert total() == content
    for value in ("T000500000", "T001234567", "T001999999"):
        may, groups = groups_that_may_hold(large, "transaction_id", value)
        assert groups >= 60 and may * 5 <= groups
    counts = read().groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert counts < 3 * 200_000 / 64


def test_range_numbers_equal_a_count_of_starts(spark):
    df = spark.createDataFrame([(i % 97 if i % 11 else None,) for i in range(500)], "v int")
    for bits in (1, 3, 8):
        starts = range_starts(df, ["v"], bits)["v"]
        assert len(starts) < 1 << bits
        number = range_number(F.col("v"), starts, df.schema["v"].dataType, bits)
        for v, n in rows(df.select("v", number)):
            assert n == (0 if v is None else sum(s <= v for s in starts))


def test_places_interleave_bits(spark):
    df = spark.range(64).selectExpr("cast(id div 8 as int) a", "cast(id % 8 as int) b")
    for a, b, place in rows(df.select("a", "b", curve_place([F.col("a"), F.col("b")], 3))):
        assert place == sum((((a >> i) & 1) << (2 * i + 1)) | (((b >> i) & 1) << (2 * i)) for i in range(3))


def test_dates_nulls_and_empty_layers(spark, sample, tmp_path):
    path = str(tmp_path / "layer")
    sample.bronze.write.partitionBy("booked_date").parquet(path)
    before = sorted(rows(read_layer(spark, path, schemas.BRONZE)), key=str)
    files = lambda: set(glob.glob(f"{path}/**/*.parquet", recursive=True))
    old = files()
    assert cluster_layer(spark, path, schemas.BRONZE, dates=["2024-01-02"]) == 1
    assert {f.split("booked_date=")[1][:10] for f in files() ^ old} == {"2024-01-02"}
    cluster_layer(spark, path, schemas.BRONZE, target_bytes=8192)
    assert sorted(rows(read_layer(spark, path, schemas.BRONZE)), key=str) == before
    assert cluster_layer(spark, path, schemas.BRONZE, dates=["1999-01-01"]) == 0
