"""Layers that readers always see whole: rows are written beside, then one small pointer is switched.

A published layer has two folders. ``parts/generation=<name>/<date column>=<date>`` holds the rows of
one write and is never changed; ``_pointers/<number>.json`` says which generation each date is read
from. The pointer of the largest number counts. A write adds a generation and then renames a complete
pointer into place, so a reader finds the dates of before or those of after, and a run that is lost
before the rename changes nothing. A DataFrame that was read earlier keeps its files until ``vacuum``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstrata.columns import DEFAULT, Columns
from ledgerstrata.sources.layers import file_system, write_layer


class PublishConflict(RuntimeError):
    """Another run has published since this one read the pointer; what it published stays."""


def _child(spark: SparkSession, root: str, *names: str):
    return spark._jvm.org.apache.hadoop.fs.Path("/".join([root.rstrip("/"), *names]))


def pointers(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the pointers that are stored, in ascending order."""
    fs, _ = file_system(spark, root)
    folder = _child(spark, root, "_pointers")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _generations(spark: SparkSession, root: str, number: int | None) -> dict[str, str]:
    """Generation by date, as text, of one pointer; one entry per calendar date."""
    if number is None:
        return {}
    fs, _ = file_system(spark, root)
    stream = fs.open(_child(spark, root, "_pointers", f"{number:012d}.json"))
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def _latest(spark: SparkSession, root: str) -> tuple[int | None, dict[str, str]]:
    number = max(pointers(spark, root), default=None)
    return number, _generations(spark, root, number)


def _switch(spark: SparkSession, root: str, before: int | None, generations: dict[str, str]) -> int:
    """Store the pointer after ``before`` by a rename, which fails where that one exists already."""
    fs, _ = file_system(spark, root)
    number = 0 if before is None else before + 1
    target = _child(spark, root, "_pointers", f"{number:012d}.json")
    beside = _child(spark, root, "_pointers", f"_{uuid.uuid4().hex}")
    fs.mkdirs(target.getParent())
    stream = fs.create(beside, False)
    try:
        stream.write(bytearray(json.dumps(generations, sort_keys=True).encode()))
    finally:
        stream.close()
    # A local file system renames over an existing file, others refuse; both ways none is replaced.
    if fs.exists(target) or not fs.rename(beside, target):
        fs.delete(beside, False)
        raise PublishConflict(f"pointer {number} of {root} was published by another run")
    return number


def _write_beside(df: DataFrame, root: str, c: Columns) -> tuple[str, list[str]]:
    """Write a generation; its name and the dates it holds."""
    spark, generation = df.sparkSession, uuid.uuid4().hex
    fs, _ = file_system(spark, root)
    folder = _child(spark, root, "parts", f"generation={generation}")
    write_layer(df, folder.toString(), c)
    names = [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()]
    return generation, [n.split("=", 1)[1] for n in names if n.startswith(f"{c.date}=")]


def publish_layer(
    df: DataFrame,
    root: str,
    c: Columns = DEFAULT,
    dates: Iterable[date | str] | None = None,
    clear: bool = False,
) -> int:
    """As ``write_layer``, for a published layer: the number of the new pointer.

    Dates present in ``df`` are replaced; with ``clear`` the other dates are emptied too, those among
    ``dates``, or all without them. All of it becomes visible at once. Rows without date are a date of
    their own. ``df`` may read the layer itself, as nothing is overwritten. If another run publishes
    in between, ``PublishConflict`` is raised and this one has no effect: run it again. Two writers
    that rename within the same moment are told apart only by file systems whose rename refuses an
    existing target (HDFS does; a local one, and object stores, need one writer at a time).
    """
    spark = df.sparkSession
    before, generations = _latest(spark, root)
    generation, written = _write_beside(df, root, c)
    if clear:
        emptied = set(generations) if dates is None else {str(d) for d in dates}
        generations = {d: g for d, g in generations.items() if d not in emptied}
    return _switch(spark, root, before, generations | dict.fromkeys(written, generation))


def published_folders(
    spark: SparkSession,
    root: str,
    dates: Iterable[date | str] | None = None,
    version: int | None = None,
    c: Columns = DEFAULT,
) -> list[str]:
    """Folders that hold the rows of the given dates, by the latest pointer or that of ``version``."""
    generations = _latest(spark, root)[1] if version is None else _generations(spark, root, version)
    wanted = set(generations) if dates is None else {str(d) for d in dates}
    return [
        _child(spark, root, "parts", f"generation={g}", f"{c.date}={d}").toString()
        for d, g in sorted(generations.items())
        if d in wanted
    ]


def read_published(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    dates: Iterable[date | str] | None = None,
    version: int | None = None,
    c: Columns = DEFAULT,
) -> DataFrame:
    """Rows of a published layer as one pointer names them, the latest or that of ``version``.

    Only the folders of the given dates are listed. A layer that was never published, or holds none
    of the dates, has no rows.
    """
    folders = published_folders(spark, root, dates, version, c)
    if not folders:
        return spark.createDataFrame([], schema)
    parts = _child(spark, root, "parts").toString()
    found = spark.read.schema(schema).option("basePath", parts).parquet(*folders)
    return found.select(*schema.fieldNames())


def published_files(spark: SparkSession, root: str, c: Columns = DEFAULT) -> DataFrame:
    """``path``, ``length`` and date of every file that the latest pointer names, from listings."""
    folders = published_folders(spark, root, c=c)
    if not folders:
        return spark.createDataFrame([], f"path string, length long, `{c.date}` date")
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("basePath", _child(spark, root, "parts").toString())
        .load(folders)
    )
    return listing.select("path", "length", F.col(c.date).cast("date").alias(c.date))


def restore(spark: SparkSession, root: str, version: int) -> int:
    """Publish what an earlier pointer named, as a new pointer; its number. No row is moved."""
    before = max(pointers(spark, root), default=None)
    return _switch(spark, root, before, _generations(spark, root, version))


def vacuum(
    spark: SparkSession, root: str, keep: int = 1, older_than_hours: float = 24.0, c: Columns = DEFAULT
) -> int:
    """Delete what none of the last ``keep`` pointers names; the number of folders deleted.

    Left alone is what was written within ``older_than_hours``: it may belong to a run that has not
    switched yet. That time must exceed the longest run and the longest read of older pointers.
    Clears up after lost runs as well.
    """
    if keep < 1:
        raise ValueError("the latest pointer has to be kept")
    fs, _ = file_system(spark, root)
    numbers = pointers(spark, root)
    named = {
        (g, d) for n in numbers[-keep:] for d, g in _generations(spark, root, n).items()
    }
    for n in numbers[:-keep]:
        fs.delete(_child(spark, root, "_pointers", f"{n:012d}.json"), False)
    before = spark._jvm.java.lang.System.currentTimeMillis() - older_than_hours * 3_600_000
    parts = _child(spark, root, "parts")
    deleted = 0
    for status in fs.listStatus(parts) if fs.exists(parts) else []:
        folder, held = status.getPath(), 0
        generation = folder.getName().split("=", 1)[1]
        for inner in fs.listStatus(folder):
            day = inner.getPath().getName().split("=", 1)[-1]
            if (generation, day) in named or inner.getModificationTime() > before:
                held += 1
            elif inner.isDirectory():
                deleted += fs.delete(inner.getPath(), True)
        if not held:
            fs.delete(folder, True)
    return deleted
