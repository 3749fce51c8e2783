"""Exact k-means over whole-number vectors by Shallot search.

Every vector keeps its centroid, the second-nearest one, an upper bound of its distance to the first
and a lower bound of its distance to all others. After centroids move the bounds are moved by as much; a
vector whose upper bound is below its lower bound, or below half the way from its centroid to the next
one, keeps its place without a distance. For the others the scan starts from the closer of the two
remembered centroids and takes its neighbours by distance: what is nearer than the second-nearest
centroid lies in a ball around the start, and the ball shrinks with each nearer centroid found. Bounds are
floating-point numbers rounded outwards; distances that decide are compared as whole numbers.

Each round reads the stored vectors with their bounds and writes them anew to shared scratch storage; a task
also writes the sums of the vectors that changed their centroid, and only these sums are aggregated.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstrata.llm.vectors import SCALE, ids_of, whole_vectors
from ledgerstrata.sources.scratch import drop_scratch, scratch_path

# Outward rounding of one floating-point step.
UP, DOWN = 1 + 2.0**-50, 1 - 2.0**-50

_ROW = (
    "vec_id long, components binary, nearest int, second int, upper double, lower double,"
    " moved array<int>, sums array<long>"
)
_RESULT = (
    "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
)


@dataclass
class Centroids:
    """Centroids with what the search needs: neighbours by distance, half ways, last movements."""

    at: np.ndarray  # whole numbers, one row per centroid
    shift: np.ndarray  # upper bounds of how far each moved

    def __post_init__(self):
        k = len(self.at)
        squares = np.stack([squared(self.at, self.at[j]) for j in range(k)]) if k else np.zeros((0, 0))
        np.fill_diagonal(squares, -1)  # so that a centroid comes first among its own neighbours
        self.neighbours = np.argsort(squares, axis=1, kind="stable")[:, 1:]
        np.fill_diagonal(squares, 0)
        self.apart = np.sqrt(squares.astype(np.float64)) * DOWN
        nearest = [self.apart[j, self.neighbours[j, 0]] if k > 1 else np.inf for j in range(k)]
        self.half = np.array(nearest) / 2
        # The largest movement of any other centroid.
        self.other_shift = np.zeros(k)
        for j in range(k):
            self.other_shift[j] = np.delete(self.shift, j).max(initial=0.0)


def squared(vectors: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Squared distances to one centroid (or to one centroid per vector), as whole numbers."""
    apart = vectors - centroid
    return np.einsum("ij,ij->i", apart, apart)


def shallot(
    x: np.ndarray, nearest: np.ndarray, second: np.ndarray, upper: np.ndarray, lower: np.ndarray,
    c: Centroids,
) -> int:
    """Assign vectors to their nearest centroids (ties: smaller number); arrays are changed in place.

    Returns the number of distances to centroids that were computed.
    """
    k = len(c.at)
    upper += c.shift[nearest]
    upper *= UP
    if k == 1:
        return 0
    lower -= c.other_shift[nearest]
    np.maximum(lower, 0, out=lower)
    lower *= DOWN
    todo = np.flatnonzero(upper >= np.maximum(lower, c.half[nearest]))
    first = squared(x[todo], c.at[nearest[todo]])
    upper[todo] = np.sqrt(first.astype(np.float64)) * UP
    open_ = upper[todo] >= np.maximum(lower[todo], c.half[nearest[todo]])
    computed = len(todo)
    todo, d1 = todo[open_], first[open_]
    if not len(todo):
        return computed
    i1, i2 = nearest[todo], second[todo]
    d2 = squared(x[todo], c.at[i2])
    computed += len(todo)
    swap = (d2 < d1) | ((d2 == d1) & (i2 < i1))
    i1, i2 = np.where(swap, i2, i1), np.where(swap, i1, i2)
    d1, d2 = np.where(swap, d2, d1), np.where(swap, d1, d2)
    start, ball = i1.copy(), np.sqrt(d1.astype(np.float64)) * UP
    known = i2.copy()  # the other remembered centroid, whose distance is known already
    for s in np.unique(start).tolist():
        rows = np.flatnonzero(start == s)
        for j in c.neighbours[s].tolist():
            # Beyond the ball a centroid is farther than the second-nearest one.
            radius = (ball[rows] + np.sqrt(d2[rows].astype(np.float64)) * UP) * UP
            rows = rows[c.apart[s, j] <= radius]
            if not len(rows):
                break
            new = rows[known[rows] != j]
            d = squared(x[todo[new]], c.at[j])
            computed += len(new)
            closest = (d < d1[new]) | ((d == d1[new]) & (j < i1[new]))
            closer = ~closest & (d < d2[new])
            a, b = new[closest], new[closer]
            i2[a], d2[a] = i1[a], d1[a]
            i1[a], d1[a] = j, d[closest]
            i2[b], d2[b] = j, d[closer]
    nearest[todo], second[todo] = i1, i2
    upper[todo] = np.sqrt(d1.astype(np.float64)) * UP
    lower[todo] = np.sqrt(d2.astype(np.float64)) * DOWN
    return computed


def _packed(matrix: np.ndarray) -> list[bytes]:
    """Vectors as bytes: 16-bit numbers if all fit, else 64-bit ones."""
    small = matrix.size == 0 or np.abs(matrix).max() < 2**15
    rows = np.ascontiguousarray(matrix.astype("<i2" if small else "<i8"))
    width = rows.shape[1] * rows.itemsize
    raw = rows.tobytes()
    return [raw[i : i + width] for i in range(0, len(raw), width)] if width else [b""] * len(rows)


def _unpacked(column: pa.Array, length: int) -> np.ndarray:
    values = column.to_pylist()
    out = np.empty((len(values), length), np.int64)
    wide = np.fromiter((len(v) > 2 * length for v in values), bool, len(values))
    for kind, chosen in (("<i2", ~wide), ("<i8", wide)):
        places = np.flatnonzero(chosen)
        if len(places):
            out[places] = np.frombuffer(b"".join(values[i] for i in places), kind).reshape(-1, length)
    return out


def _changes(x: np.ndarray, before: np.ndarray | None, after: np.ndarray) -> tuple[list, list]:
    """Centroids whose members changed, and the changes of their sums and counts, one after the other."""
    signs = [(after, 1)] if before is None else [(after, 1), (before, -1)]
    differs = np.ones(len(x), bool) if before is None else before != after
    totals: dict[int, np.ndarray] = {}
    for members, sign in signs:
        for j in np.unique(members[differs]).tolist():
            rows = x[differs & (members == j)]
            change = sign * np.append(rows.sum(axis=0), len(rows))
            totals[j] = totals.get(j, 0) + change
    return list(totals), [int(v) for change in totals.values() for v in change]


def _rows_of(
    ids: pa.Array, components: pa.Array, x: np.ndarray, before: np.ndarray | None,
    nearest: np.ndarray, second: np.ndarray, upper: np.ndarray, lower: np.ndarray,
) -> pa.RecordBatch:
    moved, sums = _changes(x, before, nearest)
    none = [None] * (len(x) - 1)
    return pa.RecordBatch.from_arrays(
        [
            ids,
            components,
            pa.array(nearest.astype(np.int32)),
            pa.array(second.astype(np.int32)),
            pa.array(upper),
            pa.array(lower),
            # Of the whole batch, on its first row.
            pa.array([moved, *none], pa.list_(pa.int32())),
            pa.array([sums, *none], pa.list_(pa.int64())),
        ],
        ["vec_id", "components", "nearest", "second", "upper", "lower", "moved", "sums"],
    )


def _first_round(
    batches: Iterator[pa.RecordBatch], c: Centroids, length: int, scale: int
) -> Iterator[pa.RecordBatch]:
    """Assign vectors that have no bounds yet."""
    for batch in batches:
        places, x = whole_vectors(batch.column(1), scale).get(length, ([], None))
        if not len(places):
            continue
        n = len(x)
        nearest, second = np.zeros(n, np.int64), np.full(n, 1, np.int64)
        upper, lower = np.full(n, np.inf), np.zeros(n)
        shallot(x, nearest, second, upper, lower, c)
        ids = batch.column(0).take(pa.array(places))
        yield _rows_of(ids, pa.array(_packed(x), pa.binary()), x, None, nearest, second, upper, lower)


def _next_round(
    batches: Iterator[pa.RecordBatch], c: Centroids, length: int
) -> Iterator[pa.RecordBatch]:
    """Assign vectors anew after centroids have moved."""
    for batch in batches:
        if not batch.num_rows:
            continue
        x = _unpacked(batch.column(1), length)
        nearest, second, upper, lower = (
            np.array(batch.column(i)) for i in range(2, 6)
        )
        nearest, second = nearest.astype(np.int64), second.astype(np.int64)
        before = nearest.copy()
        shallot(x, nearest, second, upper, lower, c)
        yield _rows_of(batch.column(0), batch.column(1), x, before, nearest, second, upper, lower)


def _distances(batches: Iterator[pa.RecordBatch], at: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Exact squared distance of each vector to its centroid."""
    for batch in batches:
        nearest = np.array(batch.column(2)).astype(np.int64)
        x = _unpacked(batch.column(1), at.shape[1])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(squared(x, at[nearest]))],
            ["vec_id", "cluster", "distance"],
        )


def _start(vectors: DataFrame, k: int, length: int, scale: int, seed: int) -> np.ndarray:
    """The vectors whose hashed ids are least, in the order of their hashes."""

    def usable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, x = whole_vectors(batch.column(1), scale).get(length, ([], None))
            if len(places):
                hashes = batch.column(2).take(pa.array(places))
                lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), length)
                yield pa.RecordBatch.from_arrays(
                    [hashes, lists.cast(pa.list_(pa.int64()))], ["hash", "components"]
                )

    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = (
        vectors.where("vec_id IS NOT NULL")
        .withColumn("hash", hashed)
        .mapInArrow(usable, "hash string, components array<long>")
        .orderBy("hash", "components")
        .limit(k)
        .collect()
    )
    return np.array([r.components for r in first], np.int64).reshape(len(first), length)


def _summed(spark: SparkSession, path: str, width: int, totals: dict[int, list[int]]) -> bool:
    """Add the changes that a round wrote to the totals of centroids; whether there were any."""
    changes = (
        spark.read.parquet(path)
        .where("sums IS NOT NULL")
        .select("moved", F.posexplode("sums").alias("place", "change"))
        .select(
            F.get("moved", (F.col("place") / width).cast("int")).alias("centroid"),
            (F.col("place") % width).alias("place"),
            F.col("change").cast("decimal(38,0)").alias("change"),
        )
        .groupBy("centroid", "place")
        .agg(F.sum("change").alias("change"))
        .collect()
    )
    for r in changes:
        totals.setdefault(r.centroid, [0] * width)[r.place] += int(r.change)
    return bool(changes)


def cluster_vectors(
    vectors: DataFrame, k: int = 8, rounds: int = 10, length: int = 64, scale: int = SCALE,
    seed: int = 3, id_column: str = "vec_id", vector_column: str = "embedding",
) -> DataFrame:
    """Clusters of vectors: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Components become floor(scale * x). Centroids start as the ``k`` vectors whose ids have the least
    lowercase-hex SHA-256 of ``seed:id`` (ids that occur twice: the lesser vector first); ``rounds``
    times vectors go to their nearest centroid and centroids that have vectors to the floor of their
    mean; then vectors are assigned once more. Distances are squared and exact, ties go to the smaller
    number, and a round that moves nothing ends the search, as all later ones would repeat it.

    NULL vectors, vectors of another length and vectors with a NULL or non-finite component are left
    out. Repeated rows are vectors of their own; a vector without id is clustered but never starts as a
    centroid. With fewer than ``k`` vectors with id there are as many centroids; with none, or with an
    empty table, there are no rows. Other columns are not read.

    The rounds run at once, each as one written table; the table before it is deleted. Only centroids
    (``k`` rows) pass through the driver.
    """
    spark = vectors.sparkSession
    source = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.col(vector_column).cast("array<double>").alias("vector"),
    )
    at = _start(source, k, length, scale, seed)
    if not len(at):
        return spark.createDataFrame([], _RESULT)
    totals: dict[int, list[int]] = {}
    c, path = Centroids(at, np.zeros(len(at))), None
    for turn in range(rounds + 1):
        if path is None:
            assigned = source.mapInArrow(lambda b, c=c: _first_round(b, c, length, scale), _ROW)
        else:
            stored = spark.read.parquet(path)
            assigned = stored.mapInArrow(lambda b, c=c: _next_round(b, c, length), _ROW)
        before, path = path, scratch_path(spark, "clusters")
        assigned.write.option("parquet.block.size", 32 << 20).parquet(path)
        if before is not None:
            drop_scratch(spark, before)
        changed = _summed(spark, path, length + 1, totals)
        if turn == rounds or not changed:
            break
        new = c.at.copy()
        for j, total in totals.items():
            if total[-1]:
                new[j] = [v // total[-1] for v in total[:-1]]
        c = Centroids(new, np.sqrt(squared(new, c.at).astype(np.float64)) * UP)
    final = spark.read.parquet(path).select("vec_id", "components", "nearest")
    found = final.mapInArrow(
        lambda b, at=c.at: _distances(b, at), "vec_id long, cluster int, distance long"
    )
    inertia = {
        r.cluster: int(r.total)
        for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()
    }
    digests = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in c.at.tolist()]
    of_cluster = spark.createDataFrame(
        [(j, total, sum(inertia.values()), digests[j]) for j, total in inertia.items()],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return found.join(F.broadcast(of_cluster), "cluster").select(*[x.split()[0] for x in _RESULT.split(", ")])
