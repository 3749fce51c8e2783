"""Near-duplicate groups: SuperMinHash signatures, banding, exact verification, union-find."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerstrata.llm.components import UnionFind, connected_components, packed
from ledgerstrata.llm.superminhash import band_keys, signatures
from ledgerstrata.llm.text import WordHasher, blank_words, fingerprint, released, shingle_hashes
from ledgerstrata.sources.scratch import cut_lineage, scratch_path

SLOTS = 200
BANDS = 40
# Rows and hashes that are signed at a time, and the members and hashes of a verification block.
_ROWS = 256
_ELEMENTS = 100_000
_BLOCK_MEMBERS = 256
_BLOCK_HASHES = 2_000_000


def _shingled(texts: Iterable[str | None], words: WordHasher, n: int) -> list[np.ndarray]:
    return [shingle_hashes(words(blank_words(text)), n) for text in texts]


def _in_slices(sets: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    """Ranges of sets with at most about ``_ELEMENTS`` elements together."""
    start = total = 0
    for i, s in enumerate(sets):
        if total and total + len(s) > _ELEMENTS:
            yield start, i
            start, total = i, 0
        total += len(s)
    if sets:
        yield start, len(sets)


def _signed(sets: list[np.ndarray], slots: int) -> np.ndarray:
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    return signatures(np.concatenate(sets), offsets, slots)


def _parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Few rows at a time: their texts, words and hashes are all in memory together."""
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            yield batch.slice(at, _ROWS)


def _sketcher(shingle: int, slots: int, bands: int):
    def sketch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHasher(200_000)
        for batch in _parts(batches):
            sets = _shingled(batch.column(1).to_pylist(), words, shingle)
            for a, b in _in_slices(sets):
                part = sets[a:b]
                keys = band_keys(_signed(part, slots), bands).view(np.int64)
                sizes = [len(s) for s in part]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array(sizes, pa.int64()),
                        pa.array([fingerprint(s) if len(s) else None for s in part], pa.binary()),
                        pa.ListArray.from_arrays(
                            np.arange(0, (len(part) + 1) * bands, bands, dtype=np.int32),
                            pa.array(keys.reshape(-1)),
                        ),
                    ],
                    ["_id", "_size", "_key", "_bands"],
                )

    return lambda batches: released(sketch(batches))


def _set_builder(shingle: int):
    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHasher(200_000)
        seen: set[tuple[int, bytes]] = set()
        for batch in _parts(batches):
            sets = _shingled(batch.column(1).to_pylist(), words, shingle)
            # The rows of an id are together here: of repeated rows one is compared.
            new = []
            for k, key in enumerate(zip(batch.column(0).to_pylist(), map(fingerprint, sets))):
                if key not in seen:
                    seen.add(key)
                    new.append(k)
            batch, sets = batch.take(pa.array(new, pa.int64())), [sets[k] for k in new]
            for a, b in _in_slices(sets):
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array([s.tobytes() for s in sets[a:b]], pa.binary()),
                        batch.column(2).slice(a, b - a),
                        batch.column(3).slice(a, b - a),
                    ],
                    ["_id", "_set", "_cluster", "_blocks"],
                )

    return lambda batches: released(build(batches))


def linked(
    ids: list[int],
    sets: list[np.ndarray],
    sides: tuple[list[int], list[int]],
    percent: int,
    slots: int = SLOTS,
    margin: float = 6.0,
) -> list[tuple[int, int]]:
    """A forest of links between two lists of positions (or within one, given twice).

    Pairs whose signatures agree in too few slots are left out: a pair at the threshold falls that
    low only ``margin`` standard deviations below its mean (1e-9). The others are compared on their
    full sets, likely ones first, except where earlier links already join the two.
    """
    signed = np.concatenate([_signed(sets[a:b], slots) for a, b in _in_slices(sets)])
    least = percent / 100
    least = (least - margin * np.sqrt(least * (1 - least) / slots)) * slots
    size = np.array([len(s) for s in sets])
    left, right = (np.array(side, np.int64) for side in sides)  # a block may be empty
    within = sides[0] == sides[1]
    near: list[tuple[int, int, int]] = []
    for k, i in enumerate(left):
        others = right[k + 1 :] if within else right
        small, large = np.minimum(size[i], size[others]), np.maximum(size[i], size[others])
        others = others[100 * small >= percent * large]
        agree = (signed[others] == signed[i]).sum(axis=1)
        near += [(-int(n), int(i), int(j)) for n, j in zip(agree, others) if n >= least]
    groups, links = UnionFind(), []
    for _, i, j in sorted(near):
        if groups.find(ids[i]) == groups.find(ids[j]):
            continue
        common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
            groups.union(ids[i], ids[j])
            links.append((ids[i], ids[j]))
    return links


def _verifier(percent: int):
    def verify(key: tuple, table: pa.Table) -> pa.Table:
        ids = table.column("_id").to_pylist()
        own = table.column("_block").to_pylist()
        sets = [np.frombuffer(s, np.uint64) for s in table.column("_set").to_pylist()]
        first, second = key[1].as_py(), key[2].as_py()
        sides = tuple([i for i, b in enumerate(own) if b == side] for side in (first, second))
        links = linked(ids, sets, sides, percent)
        return pa.table(
            {"u": pa.array([max(x) for x in links], pa.int64()),
             "v": pa.array([min(x) for x in links], pa.int64())}
        )

    return verify


def _candidate_edges(reps: DataFrame) -> DataFrame:
    """Join each text to the least id of every bucket it shares: as many edges as bucket places."""
    places = reps.select("_rep", F.explode("_bands").alias("_bucket"))
    centres = (
        places.groupBy("_bucket")
        .agg(F.min("_rep").alias("_least"), F.max("_rep").alias("_most"))
        .where("_least < _most")
        .select("_bucket", "_least")
    )
    return (
        places.join(centres, "_bucket")
        .where("_rep <> _least")
        .select(F.col("_rep").alias("u"), F.col("_least").alias("v"))
        .distinct()
    )


def _verified_links(
    texts: DataFrame, clusters: DataFrame, sizes: DataFrame, shingle: int, percent: int
) -> DataFrame:
    """Links within candidate clusters, compared on full sets in pairs of bounded blocks."""
    blocks = (
        clusters.join(sizes, clusters.node == sizes._rep)
        .groupBy("component")
        .agg(F.count("*").alias("_n"), F.sum("_size").alias("_total"))
        .select(
            "component",
            F.greatest(
                F.ceil(F.col("_n") / _BLOCK_MEMBERS), F.ceil(F.col("_total") / _BLOCK_HASHES)
            ).cast("int").alias("_blocks"),
        )
    )
    members = clusters.join(blocks, "component").select(
        F.col("node").alias("_id"), F.col("component").alias("_cluster"), "_blocks"
    )
    sets = (
        texts.join(members, "_id")
        .select("_id", "_text", "_cluster", "_blocks")
        .mapInArrow(_set_builder(shingle), "_id long, _set binary, _cluster long, _blocks int")
    )
    own = F.pmod(F.xxhash64("_id"), F.col("_blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    return (
        sets.withColumn("_block", own)
        .withColumn("_other", other)
        .select(
            "_id", "_set", "_cluster", "_block",
            F.least("_block", "_other").alias("_first"),
            F.greatest("_block", "_other").alias("_second"),
        )
        .groupBy("_cluster", "_first", "_second")
        .applyInArrow(_verifier(percent), "u long, v long")
    )


def near_duplicates(
    docs: DataFrame,
    shingle: int = 5,
    percent: int = 80,
    slots: int = SLOTS,
    bands: int = BANDS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per input row: id, ``n_shingles``, ``component_id``, ``kept``.

    Two documents are linked if their sets of word shingles have a Jaccard similarity of at least
    ``percent`` / 100, confirmed on the full sets. Words are runs without blanks, with A-Z
    lower-cased; a text of fewer than ``shingle`` words is one shingle. ``component_id`` is the
    smallest id reachable over links, ``kept`` marks the row that has it.

    1. Texts with the same set form one class, whose smallest id stands for it.
    2. SuperMinHash signatures of the classes are cut into ``bands``; with the defaults a pair at
       0.8 shares no band with probability 1e-7. Buckets give star-shaped candidate edges, so a
       bucket costs as many edges as it has members.
    3. Candidate clusters are compared inside pairs of blocks of bounded size, dealt over all
       tasks: signatures first, then full sets. A block sends on a forest of links, never all pairs.
    4. Components of those links are spread to all rows of each class.

    NULL, empty and blank texts have ``n_shingles`` 0 and are linked with nothing. Rows of equal ids
    and texts count as one document; two texts of one id are joined with each other only where it is
    the least id of both. A row with a NULL id gets the component of its text's class and is not kept if another row
    stands for it. A text that occurs only with NULL ids is linked with nothing: its rows have
    ``component_id`` NULL and are all kept. Name such rows by a key of their own to have them linked.
    Other columns are ignored. An empty table gives no rows.
    Sketches and links are stored below the checkpoint folder while the DataFrame is built.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.col(id_column).cast("long").alias("_id"), F.col(text_column).alias("_text")
    )
    path = scratch_path(spark, "sketches")
    texts.mapInArrow(
        _sketcher(shingle, slots, bands),
        "_id long, _size long, _key binary, _bands array<long>",
    ).write.parquet(path)
    sketches = spark.read.parquet(path)

    reps = (
        sketches.where("_key IS NOT NULL AND _id IS NOT NULL")
        .groupBy("_key")
        .agg(
            F.min("_id").alias("_rep"),
            F.max("_size").alias("_size"),
            F.min_by("_bands", "_id").alias("_bands"),
        )
    )
    sizes = reps.groupBy("_rep").agg(F.sum("_size").alias("_size"))
    nodes = sketches.count()
    clusters = connected_components(_candidate_edges(reps), nodes=nodes)
    # Stored, so that no task runs two Python workers at once; distinct() deals them out for few files.
    links = _verified_links(texts, clusters, sizes, shingle, percent).distinct()
    joined = connected_components(cut_lineage(packed(links, nodes)), nodes=nodes)
    classes = (
        reps.select("_key", "_rep")
        .join(joined.withColumnRenamed("node", "_rep"), "_rep", "left")
        .select("_key", F.coalesce("component", "_rep").alias("_component"))
    )
    component = F.coalesce("_component", "_id")
    return (
        sketches.select("_id", "_size", "_key")
        .join(classes, "_key", "left")
        .select(
            F.col("_id").alias(id_column),
            F.col("_size").alias("n_shingles"),
            component.alias("component_id"),
            component.eqNullSafe(F.col("_id")).alias("kept"),
        )
    )
