"""Exact search for the vectors of highest inner product: tiles, partial selection, merged lists.

Queries are packed into blocks and taken in passes of bounded size. In each pass every task holds the
pass's queries and reads its shard of the candidates once: products of a tile of queries and a tile of
candidates are one matrix product, a partial selection per tile leaves what can still enter a query's
list, and a task sends one list per query. Lists are merged per query in two levels, first those of
neighbouring shards, then the rest, so no step sorts more than a few lists of one query per shard group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerstrata.llm.vectors import SCALE, ids_of, whole_vectors
from ledgerstrata.sources.scratch import scratch_path

# A pass takes at most so many queries and components of queries.
PASS_QUERIES, PASS_COMPONENTS = 16_384, 4_000_000
# A tile has at most so many queries and candidates.
TILE_QUERIES, TILE_CANDIDATES = 1024, 4096
# Shards whose lists are merged first.
FAN_IN = 64

_BLOCK = "length int, n int, ids binary, components binary"
_ENTRY = "query long, query_id long, shard int, vec_id long, score long"


def _pack(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[pa.RecordBatch]:
    """Queries as blocks of one length: ids and components as 64-bit numbers."""
    for batch in batches:
        ids, missing = ids_of(batch.column(0))
        for length, (places, matrix) in whole_vectors(batch.column(1), scale).items():
            given = ~missing[places]
            places, matrix = places[given], matrix[given]
            step = max(1, min(TILE_QUERIES, PASS_COMPONENTS // max(1, length)))
            for i in range(0, len(places), step):
                part = places[i : i + step]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([length], pa.int32()),
                        pa.array([len(part)], pa.int32()),
                        pa.array([ids[part].astype(np.int64).tobytes()], pa.binary()),
                        pa.array([matrix[i : i + step].tobytes()], pa.binary()),
                    ],
                    ["length", "n", "ids", "components"],
                )


class Lists:
    """The best ``k`` candidates of each query so far: score descending, then id, NULL ids last."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.size = np.zeros(n, np.int64)
        self.score = np.zeros((n, k), np.int64)
        self.id = np.zeros((n, k), np.int64)
        self.missing = np.zeros((n, k), bool)

    def least(self, queries: slice, dtype: type) -> np.ndarray:
        """Score below which a candidate cannot enter a list any more."""
        lowest = np.iinfo(np.int64).min + 1 if dtype == np.int64 else np.finfo(np.float64).min
        full = self.size[queries] == self.k
        return np.where(full, self.score[queries, -1].astype(dtype), dtype(lowest))

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        """Merge entries into the lists of their queries."""
        touched = np.unique(query)
        held = np.arange(self.k) < self.size[touched][:, None]
        query = np.concatenate([np.broadcast_to(touched[:, None], held.shape)[held], query])
        score = np.concatenate([self.score[touched][held], score])
        ids = np.concatenate([self.id[touched][held], ids])
        missing = np.concatenate([self.missing[touched][held], missing])
        order = np.lexsort((ids, missing, -score, query))
        query = query[order]
        first = np.searchsorted(query, touched)
        counts = np.diff(np.append(first, len(query)))
        rank = np.arange(len(query)) - np.repeat(first, counts)
        kept = rank < self.k
        at = query[kept], rank[kept]
        self.score[at] = score[order][kept]
        self.id[at] = ids[order][kept]
        self.missing[at] = missing[order][kept]
        self.size[touched] = np.minimum(counts, self.k)


def relevant_copies(matrix: np.ndarray, ids: np.ndarray, missing: np.ndarray, k: int) -> np.ndarray:
    """Rows that can be in a list at all, by id: of equal vectors only the 2 k least, k per id at most.

    Equal vectors have equal scores, so at most ``k`` of them enter a list, those of least id that are
    not the query's own; a query's own id takes away at most ``k`` of the kept ones.
    """
    rows = np.ascontiguousarray(matrix)
    if rows.shape[1] == 0:
        group = np.zeros(len(rows), np.int64)
    else:
        raw = rows.view(np.dtype((np.void, rows.shape[1] * rows.itemsize))).ravel()
        group = np.unique(raw, return_inverse=True)[1]
    order = np.lexsort((ids, missing, group))

    def rank(*keys: np.ndarray) -> np.ndarray:
        new = np.ones(len(keys[0]), bool)
        new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in keys])
        start = np.flatnonzero(new)
        return np.arange(len(new)) - np.repeat(start, np.diff(np.append(start, len(new))))

    order = order[rank(group[order], missing[order], ids[order]) < k]
    order = order[rank(group[order]) < 2 * k]
    return np.sort(order)


def _products(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact inner products: by floating-point matrix product where all sums stay below 2^53."""
    most = [int(np.abs(x).max(initial=0)) for x in (queries, candidates)]
    if most[0] * most[1] * max(1, queries.shape[1]) < 2**53:
        return queries.astype(np.float64) @ candidates.T.astype(np.float64)
    return queries @ candidates.T


def search_tile(
    lists: Lists, at: slice, queries: np.ndarray, own: np.ndarray,
    candidates: np.ndarray, ids: np.ndarray, missing: np.ndarray,
) -> None:
    """Bring the candidates of one tile into the lists of the queries ``at``."""
    scores = _products(queries, candidates)
    never = -np.inf if scores.dtype == np.float64 else np.iinfo(np.int64).min
    # A query's own rows score below everything.
    by_id = np.argsort(ids, kind="stable")
    left, right = (np.searchsorted(ids[by_id], own, side) for side in ("left", "right"))
    for row in np.flatnonzero(right > left):
        same = by_id[left[row] : right[row]]
        scores[row, same[~missing[same]]] = never
    least = lists.least(at, scores.dtype.type)
    hit = scores >= least[:, None]
    k = lists.k
    if scores.shape[1] > k and np.count_nonzero(hit) > 4 * k * len(scores):
        least = np.maximum(least, np.partition(scores, -k, axis=1)[:, -k])
        hit = scores >= least[:, None]
    row, column = np.nonzero(hit & (scores > never))
    if len(row):
        lists.add(
            row + at.start, scores[row, column].astype(np.int64), ids[column], missing[column]
        )


def _search(batches: Iterator[pa.RecordBatch], shared, k: int, scale: int) -> Iterator[pa.RecordBatch]:
    """One list per query over the batches of a task."""
    first, own, queries = shared.value
    lists = Lists(len(own), k)
    for batch in batches:
        all_ids, all_missing = ids_of(batch.column(0))
        places, matrix = whole_vectors(batch.column(1), scale).get(queries.shape[1], ([], None))
        if not len(places):
            continue
        ids, missing = all_ids[places].astype(np.int64), all_missing[places]
        kept = relevant_copies(matrix, ids, missing, k)
        ids, missing, matrix = ids[kept], missing[kept], matrix[kept]
        for i in range(0, len(ids), TILE_CANDIDATES):
            part = slice(i, i + TILE_CANDIDATES)
            for j in range(0, len(own), TILE_QUERIES):
                at = slice(j, min(j + TILE_QUERIES, len(own)))
                search_tile(lists, at, queries[at], own[at], matrix[part], ids[part], missing[part])
    shard = TaskContext.get().partitionId() // FAN_IN
    for j in range(0, len(own), TILE_QUERIES):
        at = slice(j, min(j + TILE_QUERIES, len(own)))
        held = np.arange(k) < lists.size[at][:, None]
        query = np.broadcast_to(np.arange(at.start, at.stop)[:, None], held.shape)[held]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(query + first, pa.int64()),
                pa.array(own[query], pa.int64()),
                pa.array(np.full(len(query), shard, np.int32)),
                pa.array(lists.id[at][held], pa.int64(), mask=lists.missing[at][held]),
                pa.array(lists.score[at][held], pa.int64()),
            ],
            ["query", "query_id", "shard", "vec_id", "score"],
        )


def _merged(entries: DataFrame, k: int) -> DataFrame:
    """The best entries of each query, from the lists of all shards."""
    order = [F.desc("score"), F.asc_nulls_last("vec_id")]
    near = entries.withColumn("rank", F.row_number().over(Window.partitionBy("query", "shard").orderBy(*order)))
    near = near.where(F.col("rank") <= k)
    best = near.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order)))
    return best.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _passes(blocks: DataFrame) -> Iterator[list[int]]:
    """Numbers of blocks of one length, as many as one pass takes."""
    sizes = blocks.select("length", "n", "block").orderBy("length", "block").toLocalIterator()
    taken, length, rows = [], None, 0
    for x in sizes:
        if taken and (
            x.length != length
            or rows + x.n > PASS_QUERIES
            or (rows + x.n) * x.length > PASS_COMPONENTS
        ):
            yield taken
            taken, rows = [], 0
        taken.append(x.block)
        length, rows = x.length, rows + x.n
    if taken:
        yield taken


def exact_top_k(
    queries: DataFrame, candidates: DataFrame, k: int = 10, scale: int = SCALE,
    id_column: str = "vec_id", vector_column: str = "embedding",
) -> DataFrame:
    """The ``k`` candidates of highest inner product with each query: query_id, rank (from 1), vec_id, score.

    Scores are inner products of floor(scale * x) and exact; equal scores are ordered by id, NULL ids
    last. A query with fewer than ``k`` candidates gets all of them. Candidates that carry the query's id
    are its own and left out. Vectors that are NULL or hold a NULL or non-finite component take no part,
    nor do queries without id; vectors of another length than the query's have no product with it.
    Repeated candidates take a place each, and a repeated query is answered once per row. Empty tables
    give no rows. Other columns are not read.

    Queries are packed and written to shared scratch storage at once; each pass holds at most
    ``PASS_QUERIES`` queries, which each task receives, and scans the candidates once. Only block sizes
    (two numbers per thousand queries) and one pass of queries at a time reach the driver. With several
    passes each writes its merged lists to scratch storage.
    """
    spark = queries.sparkSession
    doubles = F.col(vector_column).cast("array<double>")
    ids = F.col(id_column).cast("long")
    packed = scratch_path(spark, "queries")
    (
        queries.select(ids, doubles)
        .mapInArrow(lambda batches: _pack(batches, scale), _BLOCK)
        .withColumn("block", F.monotonically_increasing_id())
        .write.option("parquet.block.size", 32 << 20)
        .parquet(packed)
    )
    blocks = spark.read.parquet(packed)
    shards = candidates.select(ids, doubles)
    answers: list[DataFrame] = []
    stored = scratch_path(spark, "nearest")
    first = 0
    for taken in _passes(blocks):
        if answers:  # the pass before, now that there is another
            answers.pop().write.mode("append").parquet(stored)
        rows = blocks.where(F.col("block").isin(taken)).orderBy("block").collect()
        own = np.concatenate([np.frombuffer(x.ids, np.int64) for x in rows])
        matrix = np.concatenate([np.frombuffer(x.components, np.int64).reshape(x.n, x.length) for x in rows])
        shared = spark.sparkContext.broadcast((first, own, matrix))
        entries = shards.mapInArrow(lambda b, s=shared: _search(b, s, k, scale), _ENTRY)
        answers.append(_merged(entries, k))
        several = first > 0
        first += len(own)
    if not answers:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if several:
        answers.pop().write.mode("append").parquet(stored)
        return spark.read.parquet(stored)
    return answers.pop()
