"""Tables over stored layers, and metadata about them as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerstrata.sources.schemas import LAYERS

DATABASE = "transactions_db"


def table_name(layer: str, database: str = DATABASE) -> str:
    return f"{database}.{layer}_transactions"


def register_layers(spark: SparkSession, paths: dict[str, str], database: str = DATABASE) -> None:
    """Create external tables for stored layers and load their partitions into the catalog."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for layer, path in paths.items():
        name = table_name(layer, database)
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in LAYERS[layer])
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) "
            f"USING parquet PARTITIONED BY (booked_date) LOCATION '{path}'"
        )
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")


def table_list(spark: SparkSession, database: str = DATABASE) -> DataFrame:
    """Tables of a database. ``table_type`` uses Spark's own words (MANAGED, EXTERNAL)."""
    rows = [
        (database, t.name, t.tableType)
        for t in spark.catalog.listTables(database)
        if not t.isTemporary
    ]
    schema = "table_schema string, table_name string, table_type string"
    return spark.createDataFrame(rows, schema).orderBy("table_name")


def data_dictionary(spark: SparkSession, database: str = DATABASE) -> DataFrame:
    """Every column of every table of a database, in order."""
    rows = [
        (database, t.name, col.name, position, col.dataType, "YES" if col.nullable else "NO")
        for t in spark.catalog.listTables(database)
        if not t.isTemporary
        for position, col in enumerate(spark.catalog.listColumns(f"{database}.{t.name}"), start=1)
    ]
    schema = (
        "table_schema string, table_name string, column_name string, "
        "ordinal_position int, data_type string, is_nullable string"
    )
    return spark.createDataFrame(rows, schema).orderBy("table_name", "ordinal_position")


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    """Columns of one table, partition columns marked, without Spark's extra partition rows."""
    rows = [
        (col.name, col.dataType, "partition key" if col.isPartition else "", col.description or "")
        for col in spark.catalog.listColumns(name)
    ]
    return spark.createDataFrame(rows, "column string, type string, extra string, comment string")
