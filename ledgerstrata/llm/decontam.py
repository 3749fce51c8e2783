"""Benchmark passages in documents, found by spaced seeds and verified along the alignment.

A seed mask looks at some positions of a run of words and ignores the others, so a changed word under
an ignored position does no harm. Hashes of the masked runs of all benchmark items are joined with
those of the documents; around each hit the two texts are compared word by word.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstrata.llm.text import mix, plain_words, released

WINDOW = 13
PERCENT = 80
# Fixed values. Any 13 words with at most two changed contain a run that fits one of the first two
# masks; any 5 to 12 words of which 80 % agree, one of the others.
MASKS = ("11101011", "11001111")
SHORT_MASKS = ("111", "11011")
# Bytes of an index of benchmark items, which the driver and each worker hold, at a time.
BLOCK_BYTES = 128_000_000
# Index bytes for a benchmark word (two seeds, its number, a vocabulary entry), besides its text.
_WORD_BYTES = 220
# Pairs of seeds, words compared and result rows that are held at a time.
SLICE, CELLS, ROWS = 500_000, 2_000_000, 50_000


def _offsets(mask: str) -> np.ndarray:
    return np.flatnonzero(np.frombuffer(mask.encode(), np.uint8) == ord("1"))


def _masked(ids: np.ndarray, mask: str, number: int) -> tuple[np.ndarray, np.ndarray]:
    """Places at which the mask covers known words only (id above 0), and the hashes there."""
    places = len(ids) - len(mask) + 1
    if places <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    offsets = _offsets(mask)
    known = ids > 0
    full = known[offsets[0] : offsets[0] + places].copy()
    for o in offsets[1:]:
        full &= known[o : o + places]
    at = np.flatnonzero(full)
    value = np.full(len(at), np.uint64(number))
    for o in offsets:
        value = mix(value + ids[at + o].astype(np.uint64))
    return at, value


def _runs(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of runs of rows in which the last column counts up by one and the others stay."""
    size = len(columns[0])
    if not size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = columns[-1][1:] != columns[-1][:-1] + 1
    for other in columns[:-1]:
        new |= other[1:] != other[:-1]
    starts = np.concatenate([[0], np.flatnonzero(new) + 1])
    return starts, np.diff(np.append(starts, size))


def _united(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Disjoint intervals [low, high) with the same union, in ascending order."""
    order = np.argsort(low)
    low, high = low[order], np.maximum.accumulate(high[order])
    first = np.concatenate([[True], low[1:] > high[:-1]])
    last = np.append(np.flatnonzero(first)[1:] - 1, len(low) - 1)
    return low[first], high[last]


def _spread(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The numbers of intervals [low, high), one interval after another."""
    size = high - low
    return np.repeat(high - np.cumsum(size), size) + np.arange(int(size.sum()))


class SeedIndex:
    """Seeds of a block of benchmark items: small arrays, searched in document order.

    Equal seeds at successive places of an item, as in "a a a a", are one row. Their alignments with
    a run of equal seeds of a document are an interval, so repeated words cost no more than others.
    """

    def __init__(self, items: list[tuple[int, str | None]], window: int = WINDOW, percent: int = PERCENT):
        self.window, self.percent = window, percent
        self.vocabulary: dict[bytes, int] = {}
        self.items: list[tuple[int, np.ndarray]] = []
        found: list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = [[] for _ in range(4)]
        for item_id, text in items:
            words = plain_words(text)
            if len(words) < 5 or item_id is None:
                continue
            ids = np.array(
                [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words], np.int32
            )
            masks = range(2) if len(ids) >= window else range(2, 4)
            for k in masks:
                at, value = _masked(ids, (*MASKS, *SHORT_MASKS)[k], k)
                starts, sizes = _runs(value, at)
                found[k].append((value[starts], np.full(len(starts), len(self.items)), at[starts], sizes))
            self.items.append((item_id, ids))
        self._sizes = np.array([len(own) for _, own in self.items], np.int64)
        self.seeds = []
        for k, parts in enumerate(found):
            if parts:
                value, item, at, size = (np.concatenate(x) for x in zip(*parts))
                order = np.lexsort((at, item, value))
                values, rank = np.unique(value[order], return_inverse=True)
                own = item[order]
                key = rank * len(self.items) + own
                self.seeds.append(
                    (k, values, key, own.astype(np.int32), at[order].astype(np.int32), size[order].astype(np.int32))
                )

    def _hits(self, ids: np.ndarray) -> Iterator[tuple]:
        """Per mask: the ranks of runs of known seeds, the places of the runs, and their lengths."""
        for seed in self.seeds:
            places, hashes = _masked(ids, (*MASKS, *SHORT_MASKS)[seed[0]], seed[0])
            rank = np.minimum(np.searchsorted(seed[1], hashes), len(seed[1]) - 1)
            known = np.flatnonzero(seed[1][rank] == hashes)
            if len(known):
                rank, places = rank[known], places[known]
                starts, sizes = _runs(rank, places)
                yield seed, rank[starts], places[starts], sizes

    def _groups(self, hits: list[tuple]) -> Iterator[tuple[int, int]]:
        """Ranges of items that share at most ``SLICE`` pairs of runs with a document, or single items."""
        pairs = np.zeros(len(self.items))
        for (_, _, key, item, _, _), rank, _, _ in hits:
            ranks, times = np.unique(rank, return_counts=True)
            low = np.searchsorted(key, ranks * len(self.items))
            high = np.searchsorted(key, (ranks + 1) * len(self.items))
            each = _spread(low, high)
            pairs += np.bincount(item[each], np.repeat(times, high - low), len(pairs))
        start, held = None, 0.0
        for i in np.flatnonzero(pairs).tolist():
            if start is None or held + pairs[i] > SLICE:
                if start is not None:
                    yield start, i
                start, held = i, 0.0
            held += pairs[i]
        if start is not None:
            yield start, len(self.items)

    def _shifts(self, hits: list[tuple], first: int, end: int, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Items of a range and places in the document minus places in the item that share a seed."""
        n = len(self.items)
        # Shifts as one number: an item has its words and those of the document for itself, so that
        # intervals of different items never meet.
        base = np.cumsum(self._sizes + length + 1) - (self._sizes + length + 1)
        zero = base + self._sizes
        low, high = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for (_, _, key, item, at, size), rank, place, run in hits:
            begin = np.searchsorted(key, rank * n + first)
            count = np.searchsorted(key, rank * n + end) - begin
            upto = np.cumsum(count)
            done = 0
            while done < len(count):
                # As many runs as fit, one at least.
                before = upto[done - 1] if done else 0
                until = max(done + 1, int(np.searchsorted(upto, before + SLICE, "right")))
                seed = _spread(begin[done:until], begin[done:until] + count[done:until])
                each = np.repeat(np.arange(done, until), count[done:until])
                shift = zero[item[seed]] + place[each] - at[seed]
                low = np.concatenate([low, shift - (size[seed] - 1)])
                high = np.concatenate([high, shift + run[each]])
                if len(low):
                    low, high = _united(low, high)
                done = until
        code = _spread(low, high)
        found = np.searchsorted(base, code, "right") - 1
        return found, code - zero[found]

    def overlaps(self, text: str | None) -> Iterator[tuple[np.ndarray, ...]]:
        """Alignments found, in blocks of arrays: item id, first word in the document, words, words
        that agree, first word in the item. Ordered by item and place."""
        get = self.vocabulary.get
        words = plain_words(text)
        ids = np.fromiter([get(w, 0) for w in words], np.int32, len(words))
        hits = list(self._hits(ids))
        for first, end in self._groups(hits):
            items, shifts = self._shifts(hits, first, end, len(ids))
            bounds = np.flatnonzero(np.diff(items)) + 1
            for mine, item in zip(np.split(shifts, bounds), items[np.append(0, bounds)].tolist()):
                yield from self._verified(ids, item, mine)

    def _verified(self, ids: np.ndarray, item: int, shifts: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """Compare an item with the document along each shift, a bounded number of words at a time."""
        item_id, own = self.items[item]
        size, width = len(own), min(self.window, len(own))
        for start in range(0, len(shifts), max(1, CELLS // size)):
            shift = shifts[start : start + max(1, CELLS // size)]
            # The part of the document that these shifts touch; words beyond its ends agree with none.
            low, high = int(shift[0]), int(shift[-1]) + size
            near = np.zeros(high - low, np.int32)
            inner = slice(max(low, 0), min(high, len(ids)))
            near[inner.start - low : inner.stop - low] = ids[inner]
            same = np.lib.stride_tricks.sliding_window_view(near, size)[shift - low] == own
            upto = np.zeros((len(shift), size + 1), np.int32)
            np.cumsum(same, axis=1, out=upto[:, 1:])
            good = 100 * (upto[:, width:] - upto[:, :-width]) >= self.percent * width
            place = shift[:, None] + np.arange(size - width + 1)
            good &= (place >= 0) & (place + width <= len(ids))
            kept = np.flatnonzero(good.any(axis=1))
            if not len(kept):
                continue
            good = good[kept]
            begin = good.argmax(axis=1)
            end = good.shape[1] - 1 - good[:, ::-1].argmax(axis=1) + width
            agree = upto[kept, end] - upto[kept, begin]
            yield np.full(len(kept), item_id), shift[kept] + begin, end - begin, agree, begin


_FOUND = ("item_id", "first_word", "n_words", "n_same", "item_first_word")


def benchmark_overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    percent: int = PERCENT,
    block_bytes: int = BLOCK_BYTES,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per alignment of a document with a benchmark item that it contains: the id,
    ``item_id``, ``first_word``, ``n_words``, ``n_same``, ``item_first_word``.

    A document contains an item if, without gaps, ``window`` successive words of both (all words of
    a shorter item) agree in at least ``percent`` % of their places; the defaults find every such
    place. An alignment lays the item along the document without gaps; its row spans the first to
    the last such window, so a passage that comes twice gives two rows, and repeated words give one
    for each place at which they fit. Places count words from 0; words are runs of ASCII letters in
    lower case, ASCII digits and other characters beyond ASCII.

    The benchmark is taken in blocks whose index takes about ``block_bytes``, each sent to the
    executors and held against all documents, which are never shuffled. What a task holds beside it
    is bounded by the longest text and item, not by the number of places where they agree. Items of
    fewer than five words, NULL items and items without id contain too little to be found; an id
    with several texts is found by each. NULL or empty documents contain nothing. Repeated rows give
    repeated results; a document without id keeps its NULL. Other columns are ignored; an empty table
    on either side gives no rows.
    """
    spark = docs.sparkSession
    if window != WINDOW or percent < PERCENT:
        raise ValueError("the masks are made for 13 words of which 80 % or more agree")
    known = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(
        F.col("item_id").cast("long").alias("_item"), F.col("text").alias("_text")
    )
    words = F.regexp_count("_text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))
    size = known.agg(F.sum(F.octet_length("_text") + _WORD_BYTES * words)).first()[0] or 0
    blocks = -(-size // block_bytes)
    schema = T.StructType(
        [docs.schema[id_column], *[T.StructField(n, T.LongType()) for n in _FOUND]]
    )
    if not blocks:
        return spark.createDataFrame([], schema)
    texts = docs.select(F.col(id_column), F.col(text_column).alias("_text"))
    result = None
    for block in range(blocks):
        mine = F.pmod(F.xxhash64("_item"), F.lit(blocks)) == block
        items = sorted((r[0], r[1]) for r in known.where(mine).distinct().collect())
        shared = spark.sparkContext.broadcast(SeedIndex(items, window, percent))
        found = texts.mapInArrow(_searcher(shared, id_column), schema)
        result = found if result is None else result.unionByName(found)
    return result


def _searcher(shared, id_column: str):
    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            held, size = [], 0
            for i, text in enumerate(batch.column(1)):
                for block in index.overlaps(text.as_py()):
                    held.append((np.full(len(block[0]), i), *block))
                    size += len(block[0])
                    if size >= ROWS:
                        yield as_batch(batch, held)
                        held, size = [], 0
            if held:
                yield as_batch(batch, held)

    def as_batch(batch: pa.RecordBatch, held: list[tuple]) -> pa.RecordBatch:
        rows, *numbers = (np.concatenate(x) for x in zip(*held))
        ids = batch.column(0).take(pa.array(rows))
        numbers = [pa.array(x, pa.int64()) for x in numbers]
        return pa.RecordBatch.from_arrays([ids, *numbers], [id_column, *_FOUND])

    return lambda batches: released(search(batches))
