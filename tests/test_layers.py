import pytest
from pyspark.sql import functions as F

from ledgerstrata.plans.compaction import compact_layer, scattered_dates
from ledgerstrata.sources import catalog, schemas, scratch
from ledgerstrata.sources.layers import (
    layer_exists,
    layer_files,
    read_layer,
    read_table,
    write_layer,
)
from ledgerstrata.sources.scratch import remove_scratch, scratch_path

from .conftest import rows


def test_partition_column_is_found_from_directories(spark, stored):
    found = spark.read.parquet(stored.paths.bronze)
    assert found.schema.simpleString() == schemas.BRONZE.simpleString()
    assert stored.bronze.count() == found.count() == 1005


def test_layer_files_lists_every_file_once(stored):
    files = rows(layer_files(stored.bronze))
    assert len({f for f, _ in files}) == len(files)
    assert all(f"booked_date={day}/" in path for path, day in files)
    assert {day for _, day in files} == {d for (d,) in rows(stored.bronze.select("booked_date").distinct())}


def test_write_replaces_only_the_dates_it_holds(spark, sample, tmp_path):
    path = str(tmp_path)
    write_layer(sample.bronze, path)
    write_layer(sample.bronze.where("booked_date = DATE '2024-01-02'").limit(1), path)
    per_day = dict(rows(read_layer(spark, path, schemas.BRONZE).groupBy("booked_date").count()))
    assert per_day.pop("2024-01-02") == 1
    before = dict(rows(sample.bronze.groupBy("booked_date").count()))
    before.pop("2024-01-02")
    assert per_day == before


def test_a_large_date_is_split_over_files(spark, tmp_path):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "200k")
    try:
        ids = F.sha2(F.col("id").cast("string"), 256)
        big = spark.range(0, 40_000, 1, 8).select(
            ids.alias("transaction_id"),
            F.when(F.col("id") % 3 > 0, "2024-01-01").otherwise("2024-01-02").cast("date").alias("booked_date"),
        )
        write_layer(big, str(tmp_path))
    finally:
        spark.conf.set(key, old)
    files = layer_files(spark.read.parquet(str(tmp_path)))
    assert dict(rows(files.groupBy("booked_date").count()))["2024-01-01"] > 3


def test_compaction_keeps_rows_and_stops(spark, sample, tmp_path):
    path = str(tmp_path / "layer")
    sample.bronze.repartition(6).write.partitionBy("booked_date").parquet(path)

    def layer():
        return read_layer(spark, path, schemas.BRONZE)

    before = sorted(rows(layer()), key=repr)
    files = layer_files(layer()).count()
    scattered = scattered_dates(spark, path).count()
    assert compact_layer(spark, path, schemas.BRONZE, dates=["2024-01-02"])
    assert scattered_dates(spark, path).count() == scattered - 1
    assert compact_layer(spark, path, schemas.BRONZE)
    assert sorted(rows(layer()), key=repr) == before
    assert layer_files(layer()).count() == 30 < files
    assert not compact_layer(spark, path, schemas.BRONZE)


def test_compaction_of_a_large_date_is_stable(spark, tmp_path):
    """Files stay near the target size, also for exact copies, and a second run does nothing."""
    path = str(tmp_path / "layer")
    ids = F.when(F.col("id") % 3 == 0, "copy").otherwise(F.sha2(F.col("id").cast("string"), 256))
    large = F.when(F.col("id") % 10 > 0, "2024-01-01").otherwise("2024-01-02").cast("date")
    rows_in = spark.range(0, 30_000, 1, 40).select(
        ids.alias("transaction_id"), large.alias("booked_date")
    )
    rows_in.write.partitionBy("booked_date").parquet(path)
    target = 250_000
    assert compact_layer(spark, path, target_bytes=target)
    files = dict(rows(layer_files(spark.read.parquet(path)).groupBy("booked_date").count()))
    assert 2 <= files["2024-01-01"] <= 7 and files["2024-01-02"] == 1
    assert not compact_layer(spark, path, target_bytes=target)
    assert spark.read.parquet(path).exceptAll(rows_in).isEmpty()
    assert spark.read.parquet(path).count() == 30_000


@pytest.fixture(scope="module")
def database(spark, stored):
    catalog.register_layers(spark, stored.paths.as_dict())
    yield catalog.DATABASE
    spark.sql(f"DROP DATABASE {catalog.DATABASE} CASCADE")


def test_registered_tables(spark, database, stored):
    bronze = read_table(spark, catalog.table_name("bronze"))
    assert sorted(rows(bronze), key=repr) == sorted(rows(stored.bronze), key=repr)
    assert layer_files(bronze).count() == layer_files(stored.bronze).count()
    assert rows(catalog.table_list(spark, database)) == [
        (database, "bronze_transactions", "EXTERNAL"),
        (database, "gold_transactions", "EXTERNAL"),
        (database, "silver_transactions", "EXTERNAL"),
    ]
    # Spark's own statements list the same things.
    assert database in {r[0] for r in spark.sql("SHOW SCHEMAS").collect()}
    assert len(spark.sql(f"SHOW TABLES FROM {database}").collect()) == 3
    assert "spark_catalog" in {r[0] for r in spark.sql("SHOW CATALOGS").collect()}


def test_data_dictionary(spark, database):
    entries = rows(catalog.data_dictionary(spark, database))
    assert len(entries) == 5 + 4 + 6
    gold = [e[2:5] for e in entries if e[1] == "gold_transactions"]
    assert gold == [
        ("transaction_type", 1, "string"),
        ("daily_total", 2, "decimal(18,2)"),
        ("record_count", 3, "bigint"),
        ("booked_date", 4, "date"),
    ]


def test_describe_table(spark, database):
    described = rows(catalog.describe_table(spark, catalog.table_name("silver")))
    assert [(n, t, e) for n, t, e, _ in described][-2:] == [
        ("amount_valid", "boolean", ""),
        ("booked_date", "date", "partition key"),
    ]


def test_scratch_is_removed(spark, sample):
    path = scratch_path(spark, "layer")
    write_layer(sample.gold_clean, path)
    handed_out = list(scratch._handed_out)
    scratch._handed_out[:] = [path]  # other tests still use theirs
    try:
        assert remove_scratch(spark) == 1
    finally:
        scratch._handed_out[:] = handed_out[:-1]
    assert not layer_exists(spark, path)
