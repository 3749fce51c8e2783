"""Published layers: what readers see before, during and after a write."""

import pytest
from pyspark.sql import functions as F

from ledgerstrata.columns import DEFAULT
from ledgerstrata.plans.compaction import compact_published
from ledgerstrata.sources import published, schemas
from ledgerstrata.sources.published import (
    PublishConflict,
    pointers,
    publish_layer,
    published_files,
    published_folders,
    read_published,
    restore,
    vacuum,
)

from .conftest import rows

DAY = "2024-01-09"
KIND = DEFAULT.type


def content(spark, root, **options):
    return sorted(rows(read_published(spark, root, schemas.SILVER, **options)), key=str)


@pytest.fixture()
def silver(sample):
    return sample.silver_clean


def changed(df):
    return df.where(F.col("booked_date") == DAY).withColumn(KIND, F.lit("changed"))


def test_round_trip_replaces_dates_and_keeps_the_version_before(spark, silver, tmp_path):
    root = str(tmp_path)
    assert content(spark, root) == []
    assert publish_layer(silver, root) == 0
    before = content(spark, root)
    assert before == sorted(rows(silver), key=str)
    assert publish_layer(changed(silver), root) == 1
    after = content(spark, root)
    assert len(after) == len(before) and sum("changed" in map(str, r) for r in after) > 0
    assert content(spark, root, version=0) == before
    assert restore(spark, root, 0) == 2 and content(spark, root) == before
    assert pointers(spark, root) == [0, 1, 2]


def test_a_run_lost_before_the_switch_has_no_effect(spark, silver, tmp_path, monkeypatch):
    root = str(tmp_path)
    publish_layer(silver, root)
    before = content(spark, root)

    def lost(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patched:
        patched.setattr(published, "_switch", lost)
        with pytest.raises(KeyboardInterrupt):
            publish_layer(changed(silver), root, clear=True)
    assert content(spark, root) == before and pointers(spark, root) == [0]
    # The lost generation is young, so it is kept; later it is cleared up.
    assert vacuum(spark, root) == 0
    assert vacuum(spark, root, older_than_hours=0) == 1
    assert content(spark, root) == before
    publish_layer(changed(silver), root)
    assert len(content(spark, root)) == len(before)


def test_an_open_reader_keeps_what_it_found(spark, silver, tmp_path):
    root = str(tmp_path)
    publish_layer(silver, root)
    reader = read_published(spark, root, schemas.SILVER)
    before = sorted(rows(silver), key=str)
    publish_layer(changed(silver), root, clear=True)
    assert sorted(rows(reader), key=str) == before
    assert {str(r[-1]) for r in content(spark, root)} == {DAY}


def test_the_second_of_two_runs_is_refused(spark, silver, tmp_path, monkeypatch):
    root = str(tmp_path)
    publish_layer(silver, root)
    write = published._write_beside

    def overtaken(df, root, c):
        found = write(df, root, c)
        with monkeypatch.context() as patched:
            patched.setattr(published, "_write_beside", write)
            publish_layer(silver.limit(0), root, dates=[DAY], clear=True)
        return found

    monkeypatch.setattr(published, "_write_beside", overtaken)
    with pytest.raises(PublishConflict):
        publish_layer(changed(silver), root)
    assert pointers(spark, root) == [0, 1]
    assert content(spark, root, dates=[DAY]) == []


def test_only_folders_of_wanted_dates_are_read(spark, silver, tmp_path):
    root = str(tmp_path)
    publish_layer(silver, root)
    folders = published_folders(spark, root, dates=[DAY, "1999-01-01"])
    assert len(folders) == 1 and folders[0].endswith(f"booked_date={DAY}")
    want = sorted(rows(silver.where(F.col("booked_date") == DAY)), key=str)
    assert content(spark, root, dates=[DAY]) == want


def test_rows_without_date_and_a_layer_that_reads_itself(spark, silver, tmp_path):
    root = str(tmp_path)
    dateless = silver.limit(3).withColumn("booked_date", F.lit(None).cast("date"))
    publish_layer(silver.unionByName(dateless), root)
    own = read_published(spark, root, schemas.SILVER)
    publish_layer(own.withColumn(KIND, F.upper(KIND)), root)
    got = content(spark, root)
    assert len(got) == silver.count() + 3 and sum(r[-1] is None for r in got) == 3
    assert all(r[3] == r[3].upper() for r in got)


def test_compaction_is_a_new_version(spark, silver, tmp_path):
    root = str(tmp_path)
    publish_layer(silver, root)
    before = content(spark, root)
    # Scatter one date over many files, as many small writes would.
    generation = published_folders(spark, root, dates=[DAY])[0]
    day = read_published(spark, root, schemas.SILVER, dates=[DAY]).drop("booked_date")
    for _ in range(3):
        day.limit(0).coalesce(1).write.mode("append").parquet(generation)
    files = lambda: published_files(spark, root).where(F.col("booked_date") == DAY).count()
    assert files() > 2
    assert compact_published(spark, root, schemas.SILVER)
    assert files() == 1 and content(spark, root) == before
    assert not compact_published(spark, root, schemas.SILVER)
    assert vacuum(spark, root, keep=1, older_than_hours=0) > 0
    assert content(spark, root) == before and len(pointers(spark, root)) == 1
