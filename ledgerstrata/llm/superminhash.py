"""SuperMinHash signatures (Ertl, 2017).

Each element draws a random permutation of the slots and, for its j-th slot, a value in [j, j + 1).
A slot keeps the least value over all elements. The ranks of one element are correlated (each slot
gets a different j), which lowers the variance of the estimate against independent hash functions.

The elements of many sets are taken level by level: all j-th values at once. After level j no later
value can be below j + 1, so a set stops as soon as all its slots are below that; sets much larger
than the signature need one or two levels. Neither the order of elements nor that of sets matters.
"""

from __future__ import annotations

import numpy as np

from ledgerstrata.llm.text import mix

_LEVEL = 0xD1342543DE82EF95
_MASK = (1 << 64) - 1
# Elements per pass: bounds the permutation table to this many rows.
_CHUNK = 1 << 15


def signatures(elements: np.ndarray, offsets: np.ndarray, slots: int = 128) -> np.ndarray:
    """One row of ``slots`` values per set; set i holds ``elements[offsets[i]:offsets[i + 1]]``.

    Elements are distinct 64-bit hashes. A set without elements has infinity in every slot.
    """
    n_sets = len(offsets) - 1
    best = np.full((n_sets, slots), np.inf)
    owner = np.repeat(np.arange(n_sets), np.diff(offsets))
    for start in range(0, len(elements), _CHUNK):
        _take(best, elements[start : start + _CHUNK], owner[start : start + _CHUNK], slots)
    return best


def _take(best: np.ndarray, elements: np.ndarray, owner: np.ndarray, slots: int) -> None:
    flat = best.reshape(-1)
    places: np.ndarray | None = None
    for level in range(slots):
        if level:
            open_sets = best.max(axis=1) >= level
            alive = open_sets[owner]
            if not alive.any():
                return
            if places is None:
                places = np.tile(np.arange(slots, dtype=np.int16), (int(alive.sum()), 1))
                # Level 0 swapped place 0 with the place it drew.
                rows, drawn = np.arange(len(places)), first[alive]
                places[rows, drawn] = 0
                places[:, 0] = drawn
            elif not alive.all():
                places = places[alive]
            if not alive.all():
                elements, owner = elements[alive], owner[alive]
        bits = mix(elements + np.uint64((level + 1) * _LEVEL & _MASK))
        drawn = level + ((bits >> np.uint64(32)) % np.uint64(slots - level)).astype(np.int64)
        value = level + (bits & np.uint64(0xFFFFFFFF)).astype(np.float64) / 4294967296.0
        if level == 0:
            first, slot = drawn, drawn
        else:
            rows = np.arange(len(places))
            slot = places[rows, drawn].astype(np.int64)
            places[rows, drawn] = places[:, level]
            places[:, level] = slot
        np.minimum.at(flat, owner * slots + slot, value)


def band_keys(best: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key per set and band of equal numbers of slots."""
    n_sets, slots = best.shape
    values = np.ascontiguousarray(best).view(np.uint64).reshape(n_sets, bands, slots // bands)
    keys = np.broadcast_to(np.arange(bands, dtype=np.uint64), (n_sets, bands)).copy()
    for i in range(values.shape[2]):
        keys = mix(keys * np.uint64(_LEVEL) + values[:, :, i])
    return keys
