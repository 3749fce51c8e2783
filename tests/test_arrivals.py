"""Arriving files: each is taken once, and layers equal those of one run over everything."""

import json

import pytest
from pyspark.sql import functions as F

from ledgerstrata.plans import jobs
from ledgerstrata.plans.jobs import LayerPaths
from ledgerstrata.sources import schemas
from ledgerstrata.sources.layers import read_layer
from ledgerstrata.streaming import arrivals
from ledgerstrata.streaming.arrivals import (
    ArrivalStore,
    file_ledger,
    raw_schema,
    read_arrivals,
    rejected_text,
    run_arrivals,
    take_new_files,
)

from .conftest import rows

NAMES = ["transaction_id", "booked_at", "amount", "transaction_type"]
SCHEMA = raw_schema(NAMES)


def line(i, day, amount="1.00", kind="fee"):
    return json.dumps(dict(zip(NAMES, (f"T{i}", f"2024-01-{day:02d} 10:00:00", amount, kind))))


@pytest.fixture()
def place(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    return folder, ArrivalStore(str(tmp_path / "store")), LayerPaths(str(tmp_path / "lake"))


def layers(spark, paths):
    read = lambda path, schema: sorted(rows(read_layer(spark, path, schema)), key=str)
    return [read(paths.bronze, schemas.BRONZE), read(paths.silver, schemas.SILVER), read(paths.gold, schemas.GOLD)]


def test_three_runs_over_a_growing_folder_equal_one(spark, place, tmp_path):
    folder, store, paths = place
    run = lambda: run_arrivals(spark, str(folder), store, paths, SCHEMA)
    assert run() == []
    (folder / "a.json").write_text("\n".join([line(1, 1), line(2, 2), line(2, 2)]))
    assert run() == ["2024-01-01", "2024-01-02"]
    (folder / "b.json").write_text("\n".join([line(3, 2), line(4, 3)]))
    (folder / "empty.json").write_text("")
    assert run() == ["2024-01-02", "2024-01-03"]
    assert run() == []
    (folder / "c.json").write_text("\n".join([line(1, 3, "5.00"), line(5, 1)]))
    run()
    whole = LayerPaths(str(tmp_path / "whole"))
    jobs.run_bronze(spark.read.schema(SCHEMA).json(str(folder)), whole)
    jobs.run_silver(spark, whole)
    jobs.run_gold(spark, whole)
    assert layers(spark, paths) == layers(spark, whole)
    ledger = {r.path.rsplit("/", 1)[1]: r.n_rows for r in file_ledger(read_arrivals(spark, store, SCHEMA)).collect()}
    assert ledger == {"a.json": 3, "b.json": 2, "c.json": 2}


def test_a_lost_run_is_made_good(spark, place, monkeypatch):
    folder, store, paths = place
    (folder / "a.json").write_text("\n".join([line(1, 1), line(2, 2)]))

    def lost(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patched:
        patched.setattr(arrivals, "run_silver", lost)
        with pytest.raises(KeyboardInterrupt):
            run_arrivals(spark, str(folder), store, paths, SCHEMA)
    assert run_arrivals(spark, str(folder), store, paths, SCHEMA) == ["2024-01-01", "2024-01-02"]
    assert [len(x) for x in layers(spark, paths)] == [2, 2, 2]
    assert read_arrivals(spark, store, SCHEMA).count() == 2


def test_rejected_text_keeps_its_reason(spark, place):
    folder, store, paths = place
    bad_time = line(3, 1).replace("2024-01-01 10", "noon")
    (folder / "a.json").write_text("\n".join([line(1, 1), "{broken", line(2, 1, "much"), bad_time]))
    assert run_arrivals(spark, str(folder), store, paths, SCHEMA) == ["2024-01-01"]
    found = rejected_text(read_arrivals(spark, store, SCHEMA))
    assert sorted(rows(found.select("reason", "text"))) == [
        ("bad_amount", "much"), ("bad_time", "noon:00:00"), ("malformed", "{broken"),
    ]
    bronze = read_layer(spark, paths.bronze, schemas.BRONZE)
    assert sorted(rows(bronze.select("transaction_id", "amount")), key=str) == [("T1", 1.0), ("T2", None)]
    assert spark.read.parquet(paths.quarantine).select("transaction_id").first()[0] == "T3"


def test_csv_and_small_batches(spark, place):
    folder, store, _ = place
    for i in range(5):
        (folder / f"{i}.csv").write_text(f"T{i},2024-01-0{i + 1} 10:00:00,1.00,fee\n")
    take_new_files(spark, str(folder), store, SCHEMA, "csv", files_per_batch=2)
    taken = read_arrivals(spark, store, SCHEMA)
    assert taken.select("taken").distinct().count() == 3 and taken.count() == 5
    one = taken.where(F.col("day") == "2024-01-03")
    assert one.count() == 1 and "PartitionFilters: [isnotnull(day" in one._jdf.queryExecution().toString()
