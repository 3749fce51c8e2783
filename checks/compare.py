"""Run queries and their DuckDB statements side by side: ``python -m checks.compare SF_DIR [NAME...]``."""

from __future__ import annotations

import datetime
import glob
import math
import os
import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks import oracle, registry


def local_session(cpus: int = 8, name: str = "ledgerstrata") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        # Recording the Python call site of every Column costs more than planning small queries.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        table = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def difference(name: str, df: DataFrame, con: duckdb.DuckDBPyConnection) -> str | None:
    """What differs between a query and its statement; None if they agree."""
    got = _rows(df.columns, df.collect())
    cursor = con.execute(oracle.statements()[name])
    columns = [d[0] for d in cursor.description]
    want = _rows(columns, cursor.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if repr(g) != repr(w)]
    return f"{len(wrong)} rows, first {wrong[0]}" if wrong else None


def main(sf_dir: str, names: list[str]) -> int:
    spark, con = local_session(), connect(sf_dir)
    failed = 0
    for name in names or registry.QUERIES:
        start = time.perf_counter()
        df = registry.run(name, spark, sf_dir)
        problem = difference(name, df, con)
        failed += problem is not None
        print(f"{name:32} {time.perf_counter() - start:6.2f}s  {problem or 'equal'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
