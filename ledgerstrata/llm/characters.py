"""Character classes, lower case and normal forms of one Unicode version, whatever is installed.

The tokenizer library splits texts by the letters, numbers and blanks of Unicode 16.0, lower-cases by
Unicode 17.0, and normalizes by Unicode 9.0. The tables here start from those of the Python
installation, of a known version, and add what the differences are. Where the ``regex`` package
classes a character differently, the character is given a stand-in of the right class for the split.
"""

from __future__ import annotations

import unicodedata
from functools import cache

import numpy as np
import regex

# Letters and numbers that came after Unicode 15.0, up to 16.0 (first, last).
LETTERS_SINCE_15 = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65),
    (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E),
    (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0),
    (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED),
    (0x1E5F0, 0x1E5F0), (0x2EBF0, 0x2EE5D),
)
NUMBERS_SINCE_15 = (
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
    (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
)

# The blanks of a split.
BLANKS = (
    (0x09, 0x0D), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
    (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
)

# Lower case that came after Unicode 15.0, up to 17.0 (first, last, step to lower case).
LOWER_SINCE_15 = (
    (0x1C89, 0x1C89, 1), (0xA7CB, 0xA7CB, 0x264 - 0xA7CB), (0xA7CC, 0xA7CC, 1), (0xA7CE, 0xA7CE, 1),
    (0xA7D2, 0xA7D2, 1), (0xA7D4, 0xA7D4, 1), (0xA7DA, 0xA7DA, 1), (0xA7DC, 0xA7DC, 0x19B - 0xA7DC),
    (0x10D50, 0x10D65, 0x20), (0x16EA0, 0x16EB8, 0x1B),
)

# Marks, and the parts of one letter, that came after Unicode 9.0. A normal form of that
# version knows nothing of them: they stand where they are and join with nothing.
MARKS_SINCE_9 = (
    (0x7FD, 0x7FD), (0x898, 0x89F), (0x8CA, 0x8D3), (0x9FE, 0x9FE), (0xC3C, 0xC3C), (0xD3B, 0xD3C),
    (0xEBA, 0xEBA), (0x1715, 0x1715), (0x1ABF, 0x1ACE), (0x1DF6, 0x1DFA), (0xA82C, 0xA82C),
    (0x10D24, 0x10D27), (0x10EAB, 0x10EAC), (0x10EFD, 0x10EFF), (0x10F46, 0x10F50), (0x10F82, 0x10F85),
    (0x11070, 0x11070), (0x1133B, 0x1133B), (0x1145E, 0x1145E), (0x11839, 0x1183A), (0x11930, 0x11930),
    (0x1193D, 0x1193E), (0x11943, 0x11943), (0x119E0, 0x119E0), (0x11A34, 0x11A34), (0x11A47, 0x11A47),
    (0x11A99, 0x11A99), (0x11D42, 0x11D42), (0x11D44, 0x11D45), (0x11D97, 0x11D97), (0x11F41, 0x11F42),
    (0x16FF0, 0x16FF1), (0x1E08F, 0x1E08F), (0x1E130, 0x1E136), (0x1E2AE, 0x1E2AE), (0x1E2EC, 0x1E2EF),
    (0x1E4EC, 0x1E4EF),
)

# Versions of the installation's tables that the differences above complete.
KNOWN_VERSIONS = ("15.0.0", "15.1.0")

OTHER, LETTER, NUMBER, BLANK = range(4)
# A character of each class that no pattern names, in the order above.
_STAND_INS = "¤ā² "


def _members(ranges: tuple) -> frozenset[str]:
    return frozenset(chr(c) for first, last, *_ in ranges for c in range(first, last + 1))


LATER_MARKS = _members(MARKS_SINCE_9)
LATER_CAPITALS = _members(LOWER_SINCE_15)
_TO_LOWER = {c: c + step for first, last, step in LOWER_SINCE_15 for c in range(first, last + 1)}


@cache
def classes() -> np.ndarray:
    """Class of each code point as the tokenizer library has it."""
    if unicodedata.unidata_version not in KNOWN_VERSIONS:
        raise RuntimeError(
            f"character tables for Unicode {unicodedata.unidata_version} are not known; "
            f"needed is a Python with one of {', '.join(KNOWN_VERSIONS)}"
        )
    first = "".join(unicodedata.category(chr(c))[0] for c in range(0x110000))
    letters = np.frombuffer(first.encode(), np.uint8)
    found = np.where(letters == ord("L"), LETTER, np.where(letters == ord("N"), NUMBER, OTHER))
    for kind, ranges in ((LETTER, LETTERS_SINCE_15), (NUMBER, NUMBERS_SINCE_15), (BLANK, BLANKS)):
        for a, b in ranges:
            found[a : b + 1] = kind
    return found.astype(np.uint8)


@cache
def stand_ins() -> dict[int, str]:
    """For characters that the ``regex`` package classes differently: one of the right class."""
    given = np.full(0x110000, OTHER, np.uint8)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    text = "".join(map(chr, points))
    place = np.array(points)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (BLANK, r"\s+")):
        for m in regex.finditer(pattern, text):
            given[place[m.start() : m.end()]] = kind
    known = classes()
    return {c: _STAND_INS[known[c]] for c in np.flatnonzero(given != known).tolist()}


@cache
def odd_characters() -> frozenset[str]:
    return frozenset(map(chr, stand_ins()))


def split(pattern: regex.Pattern, text: str) -> list[str]:
    """All matches of a split pattern, by the character classes of the tokenizer library."""
    if text.isascii() or odd_characters().isdisjoint(text):
        return pattern.findall(text)
    shadow = text.translate(stand_ins())
    return [text[m.start() : m.end()] for m in pattern.finditer(shadow)]


def normal(text: str) -> str:
    """NFC of Unicode 9.0."""
    if text.isascii():
        return text
    if LATER_MARKS.isdisjoint(text):
        return unicodedata.normalize("NFC", text)
    out, start = [], 0
    for i, c in enumerate(text):
        if c in LATER_MARKS:
            out += [unicodedata.normalize("NFC", text[start:i]), c]
            start = i + 1
    return "".join(out) + unicodedata.normalize("NFC", text[start:])


def lower(text: str) -> str:
    """Lower case of Unicode 17.0, each character by itself: sigma has one form wherever it stands."""
    if text.isascii():
        return text.lower()
    if not LATER_CAPITALS.isdisjoint(text):
        text = text.translate(_TO_LOWER)
    return text.replace("Σ", "σ").lower()
