"""Connected components of an undirected graph given as a table of edges."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerstrata.sources.scratch import cut_lineage


class UnionFind:
    """Disjoint sets; the root of a set is its smallest member."""

    def __init__(self):
        self.parent: dict = {}

    def find(self, x):
        parent = self.parent
        root = parent.setdefault(x, x)
        while parent[root] != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    def union(self, x, y) -> bool:
        """Join two sets; False if they were one already."""
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        self.parent[max(x, y)] = min(x, y)
        return True


# Nodes that one task remembers before it passes on what it has joined; bounds its memory.
_NODES = 500_000
# Nodes whose edges lie in one stored partition, where their number is known.
_NODES_STORED = 20_000


def _joined_in_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sets = UnionFind()

    def stars() -> pa.RecordBatch:
        found = [(x, sets.find(x)) for x in list(sets.parent)]
        pairs = [(x, root) for x, root in found if x != root]
        return pa.RecordBatch.from_pydict(
            {"u": pa.array([x for x, _ in pairs], pa.int64()),
             "v": pa.array([r for _, r in pairs], pa.int64())}
        )

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            sets.union(u, v)
        if len(sets.parent) > _NODES:
            yield stars()
            sets = UnionFind()
    yield stars()


def packed(df: DataFrame, nodes: int | None) -> DataFrame:
    """Rows of a graph of ``nodes`` nodes in as many partitions as are of use, never in more than before.

    Each stored partition is a file, and Hadoop's local file system starts processes for each file,
    which for a moment share, and seem to double, the memory of the executor that starts them.
    """
    return df if nodes is None else df.coalesce(max(1, -(-nodes // _NODES_STORED)))


def connected_components(
    edges: DataFrame, max_rounds: int = 60, nodes: int | None = None
) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node of ``edges`` (``u``, ``v``).

    Each task first replaces its edges by a union-find forest. Rounds of large-star and small-star
    steps then bring every node beside the least node of its component; a round has two shuffles
    that send minima and edges, never a whole component to one task. Rounds grow with the logarithm
    of the longest path. Rows with a NULL end are left out; no edges give no rows. Stored rounds go
    to the checkpoint folder, in few files where ``nodes`` says how many nodes there are, about or at most.
    """
    both = edges.select(F.col("u").cast("long"), F.col("v").cast("long")).where("u <> v")
    # v is the smaller end from here on.
    forest = both.mapInArrow(_joined_in_task, "u long, v long").distinct()
    forest = cut_lineage(packed(forest, nodes))
    state = None
    for _ in range(max_rounds):
        forest = cut_lineage(packed(_small_star(_large_star(forest)), nodes))
        row = forest.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if row == state:
            break
        state = row
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = forest.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return forest.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _large_star(forest: DataFrame) -> DataFrame:
    """Join every larger neighbour of a node to the least of the node and its neighbours."""
    ends = forest.union(forest.select("v", "u"))
    least = ends.groupBy("u").agg(F.min("v").alias("_least"))
    least = least.select("u", F.least("u", "_least").alias("_least"))
    return (
        ends.where("v > u")
        .join(least, "u")
        .select(F.col("v").alias("u"), F.col("_least").alias("v"))
        .distinct()
    )


def _small_star(forest: DataFrame) -> DataFrame:
    """Join a node and its smaller neighbours to the least of them."""
    least = forest.groupBy("u").agg(F.min("v").alias("_least"))
    moved = (
        forest.join(least, "u")
        .select(F.col("v").alias("u"), F.col("_least").alias("v"))
        .where("u <> v")
    )
    return moved.union(least.select("u", "_least")).distinct()
