"""Vectors of whole numbers, shared by the operators on embeddings."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa

SCALE = 1024


def largest_component(length: int) -> int:
    """Largest size of a component for which squared distances of such vectors fit 64 bits."""
    return math.isqrt(2**61 // max(1, length)) - 1


def whole_vectors(column: pa.Array, scale: int = SCALE) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length: positions of the usable vectors of a column, and floor(scale * x) of their components.

    A vector is usable if neither it nor a component is NULL and all components are finite. Components
    so large that distances would not fit 64 bits raise a ValueError.
    """
    offsets = np.asarray(column.offsets).astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)  # NULL: nan
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    usable = np.asarray(column.is_valid()) & (bad[offsets[1:]] == bad[offsets[:-1]])
    lengths = np.diff(offsets)
    found = {}
    for length in np.unique(lengths[usable]).tolist():
        places = np.flatnonzero(usable & (lengths == length))
        scaled = np.floor(values[offsets[places][:, None] + np.arange(length)] * scale)
        most = largest_component(length)
        if scaled.size and np.abs(scaled).max() > most:
            raise ValueError(f"components beyond {most / scale} would not fit 64-bit distances")
        found[length] = places, scaled.astype(np.int64)
    return found


def ids_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Whole-number ids of a column with 0 for NULL, and where they are NULL."""
    return column.fill_null(0).to_numpy(zero_copy_only=False), np.asarray(column.is_null())
