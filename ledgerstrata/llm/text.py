"""Words and stable 64-bit hashes, shared by the operators that work on word sequences."""

from __future__ import annotations

import gc
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash

# Odd multipliers of the mixing function (splitmix64) and of the n-gram polynomial; fixed values.
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x100000001B3)

# A-Z to a-z; the six blanks of the class [\x20\x09-\x0D] are what bytes.split() splits on.
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit integers, so that near inputs give unrelated outputs."""
    x = x + _GOLDEN
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


def blank_words(text: str | None) -> list[bytes]:
    """UTF-8 words between blanks (space, \\t, \\n, \\v, \\f, \\r), with A-Z lower-cased."""
    return text.encode("utf-8", "replace").translate(_LOWER).split() if text else []


# ASCII letters in lower case and digits are kept, as are all other characters; the rest separates.
_SEPARATE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32
    for c in range(256)
)


def separate(text: str) -> bytes:
    """UTF-8 with A-Z lower-cased and a space in place of each byte that is not part of a plain word."""
    return text.encode("utf-8", "replace").translate(_SEPARATE)


def plain_words(text: str | None) -> list[bytes]:
    """UTF-8 words: runs of ASCII letters (lower-cased), ASCII digits and other characters."""
    return separate(text).split() if text else []


# Characters or bytes of words and chunks that a memory holds at most, besides those of one text.
MEMORY = 30_000_000


def released(rows: Iterable) -> Iterator:
    """Pass rows on, and give memory that is no longer used back to the system when they end.

    Python workers wait for further tasks between stages, with all they hold.
    """
    yield from rows
    gc.collect()
    pa.default_memory_pool().release_unused()


class WordHasher:
    """64-bit hashes of words, remembered for the words of the last few batches.

    The memory is emptied when it holds ``limit`` words or ``MEMORY`` bytes of them, so it stays small
    whatever the corpus.
    """

    def __init__(self, limit: int = 400_000):
        self._known: dict[bytes, int] = {}
        self._held = 0
        self._limit = limit

    def __call__(self, words: Sequence[bytes]) -> np.ndarray:
        known = self._known
        if len(known) > self._limit or self._held > MEMORY:
            known.clear()
            self._held = 0
        try:
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            for word in set(words).difference(known):
                known[word] = xxhash.xxh3_64_intdigest(word)
                self._held += len(word)
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Distinct hashes of the runs of ``n`` words, sorted; of the whole text if it is shorter.

    A shorter text is hashed together with its length, so it never equals a full run.
    """
    size = len(words)
    if size == 0:
        return np.zeros(0, np.uint64)
    width = min(n, size)
    total = np.full(size - width + 1, np.uint64(width))
    for i in range(width):
        total = mix(total * _STEP + words[i : size - width + 1 + i])
    return np.unique(total)


def fingerprint(hashes: np.ndarray) -> bytes:
    """128-bit fingerprint of a sorted array of hashes."""
    return xxhash.xxh3_128_digest(hashes.tobytes())
