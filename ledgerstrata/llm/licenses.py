"""Licence notices and identifier tags in texts.

One Aho-Corasick pass over the words of a text finds all notice phrases and the words of identifier
tags. Where a tag stands, the longest well-formed licence expression behind it is read by a shunting-yard
parser and evaluated: of alternatives (``or``) the mildest terms count, of joint licences (``and``) the
strictest, and an exception (``with``) softens a reciprocal licence.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerstrata.llm.text import plain_words, separate

# Base phrases and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Further phrases and labels of the method.
PHRASES = {
    "gnu general public license version 2": "gpl-2.0",
    "gnu general public license version 3": "gpl-3.0",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "apache license version 2 0": "apache-2.0",
    "mozilla public license": "mpl",
    "bsd license": "bsd",
    "boost software license": "bsl",
    "isc license": "isc",
    "the unlicense": "unlicense",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc0": "cc0",
    "creative commons attribution": "cc-by",
    "all rights reserved": "all-rights-reserved",
}
_TAG_WORDS = "spdx license identifier"
_TAG = b"spdx-license-identifier:"
_WORD = re.compile(rb"[^ ]+")
_TOKEN = re.compile(r"\(|\)|[A-Za-z0-9][A-Za-z0-9.+:-]*")
_NEXT = re.compile(rf"[ \t]*({_TOKEN.pattern})")
_PRECEDENCE = {"or": 1, "and": 2, "with": 3}

# Terms, from mild to strict, by the beginning of an identifier; the longest beginning counts.
TERMS = ("permissive", "reciprocal", "non-commercial", "unknown", "reserved")
UNKNOWN = TERMS.index("unknown")
_TERM_OF = {
    "0bsd": 0, "apache": 0, "bsd": 0, "bsl": 0, "cc-by": 0, "cc0": 0, "isc": 0, "mit": 0, "unlicense": 0, "zlib": 0,
    "gpl": 1, "lgpl": 1, "agpl": 1, "mpl": 1, "epl": 1, "cc-by-sa": 1,
    "cc-by-nc": 2, "cc-by-nd": 2, "all-rights-reserved": 4, "proprietary": 4,
}


def term_of(identifier: str) -> int:
    """How strict a licence is. Of one that is not known nothing can be granted: it has a term of its
    own, stricter than those of known public licences."""
    known = [k for k in _TERM_OF if identifier == k or re.match(re.escape(k) + "[-+.]", identifier)]
    return _TERM_OF[max(known, key=len)] if known else UNKNOWN


def leading_expression(text: str) -> str:
    """The longest well-formed expression that ``text`` begins with; empty if it begins with none.

    Tokens follow one another with blanks or tabs between them. What cannot continue an expression
    ends it: two identifiers in a row, another character, a dot, comma or semicolon behind a token.
    """
    at = depth = end = 0
    operand_next, ended = True, False
    while not ended and (found := _NEXT.match(text, at)):
        whole = found[1]
        token = whole.lower().rstrip(".")
        ended, at = token != whole.lower(), found.start(1) + len(token)
        joins = token in _PRECEDENCE or token == ")"
        if operand_next == joins or (token == ")" and not depth):
            break
        depth += (token == "(") - (token == ")")
        operand_next = token in _PRECEDENCE or token == "("
        if not operand_next and not depth:
            end = at
    return text[:end].strip()


def to_postfix(tokens: list[str]) -> list[str] | None:
    """Shunting-yard: operators behind their operands; None if the expression is malformed."""
    out: list[str] = []
    stack: list[str] = []
    operand_next = True
    for token in tokens:
        if token in _PRECEDENCE:
            if operand_next:
                return None
            while stack and stack[-1] != "(" and _PRECEDENCE[stack[-1]] >= _PRECEDENCE[token]:
                out.append(stack.pop())
            stack.append(token)
            operand_next = True
        elif token == "(":
            if not operand_next:
                return None
            stack.append(token)
        elif token == ")":
            if operand_next:
                return None
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                return None
            stack.pop()
        else:
            if not operand_next:
                return None
            out.append(token)
            operand_next = False
    if operand_next or "(" in stack:
        return None
    return out + stack[::-1]


@dataclass(frozen=True)
class Expression:
    """Licence identifiers of an expression in order, and its terms (None if malformed)."""

    identifiers: tuple[str, ...]
    term: int | None


def evaluate(text: str) -> Expression:
    """Read a licence expression; identifiers are lower-cased, and exceptions are none of them."""
    tokens = [t.lower().rstrip(".,;") for t in _TOKEN.findall(text)]
    postfix = to_postfix(tokens)
    if postfix is None:
        named = [
            t for i, t in enumerate(tokens)
            if t not in _PRECEDENCE and t not in "()" and (not i or tokens[i - 1] != "with")
        ]
        return Expression(tuple(dict.fromkeys(named)), None)
    # Operands are (terms, identifiers).
    stack: list[tuple[int, list[str]]] = []
    for token in postfix:
        if token not in _PRECEDENCE:
            stack.append((term_of(token), [token]))
            continue
        (right, more), (left, names) = stack.pop(), stack.pop()
        if token == "with":
            stack.append((0 if left == 1 else left, names))
        else:
            stack.append(((min if token == "or" else max)(left, right), names + more))
    term, names = stack[0]
    return Expression(tuple(dict.fromkeys(names)), term)


class Scanner:
    """Finds notices and tags in one text after another."""

    def __init__(self, phrases: dict[str, str] | None = None):
        self._found = ahocorasick.Automaton()
        entries: dict[str, list[tuple[str, bool]]] = {_TAG_WORDS: []}
        for table, base in ((BASE_PHRASES, True), (PHRASES | (phrases or {}), False)):
            for phrase, label in table.items():
                entries.setdefault(phrase, []).append((label, base))
        for phrase, labels in entries.items():
            # Blanks on both sides: whole words only.
            key = f" {phrase} ".encode().decode("latin-1")
            self._found.add_word(key, (len(key), phrase == _TAG_WORDS, labels))
        self._found.make_automaton()

    def __call__(self, text: str | None) -> tuple:
        """n_words, n_base, first and last base place, base labels, labels, score, terms."""
        words = plain_words(text)
        line = b" ".join([b"", *words, b""]).decode("latin-1")
        places: list[int] = []
        base: set[str] = set()
        labels: set[str] = set()
        tags: list[int] = []
        hits = covered = 0
        word = at = 0
        term: int | None = None
        for end, (size, is_tag, found) in sorted(self._found.iter(line), key=lambda x: x[0] - x[1][0]):
            start = end - size + 1
            # Word number: one blank stands before each word.
            word += line.count(" ", at, start)
            at = start
            if is_tag:
                tags.append(word)
                continue
            # Phrases that overlap are one notice; the blank between two of them is in both.
            hits += start >= covered - 1
            covered = max(covered, end + 1)
            for label, is_base in found:
                labels.add(label)
                if is_base:
                    base.add(label)
                    places.append(word)
                term = max(term or 0, term_of(label))
        read = [e for e in self._expressions(text, tags) if e.term is not None] if tags else []
        for expression in read:
            labels.update(expression.identifiers)
            term = max(term or 0, expression.term)
        return (
            len(words),
            len(places),
            min(places, default=None),
            max(places, default=None),
            ",".join(sorted(base)),
            ",".join(sorted(labels)),
            1.0 - 0.5 ** min(hits + 2 * len(read), 60),
            None if term is None else TERMS[term],
        )

    @staticmethod
    def _expressions(text: str, tags: list[int]) -> Iterator[Expression]:
        """Expressions behind the tags whose first words have these numbers, up to the ends of lines."""
        own, separated = text.encode("utf-8", "replace"), separate(text)
        starts = enumerate(m.start() for m in _WORD.finditer(separated))
        for number in tags:
            at = next(start for i, start in starts if i == number)
            if own[at : at + len(_TAG)].lower() != _TAG:
                continue
            line_end = min((e for e in (own.find(b"\n", at), own.find(b"\r", at)) if e >= 0), default=len(own))
            rest = own[at + len(_TAG) : line_end].decode("utf-8", "replace")
            yield evaluate(leading_expression(rest))


_COLUMNS = {
    "n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(),
    "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(), "terms": pa.string(),
}


def scan_licenses(
    docs: DataFrame,
    phrases: dict[str, str] | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_words``, ``n_base``, ``first_word``, ``last_word``,
    ``base_labels``, ``labels``, ``score``, ``terms``.

    Words are runs of ASCII letters in lower case, ASCII digits and characters beyond ASCII.
    ``n_base`` counts all places of base phrases, ``first_word`` and ``last_word`` are the least and
    largest of them (NULL without any). ``labels`` adds those of longer phrases, of ``phrases`` (phrase
    in words to label) and the identifiers of tagged expressions; both lists are distinct, sorted and
    joined by commas. ``score`` grows from 0 (nothing found) towards 1 with the notices (overlapping
    phrases are one) and the tags that an expression follows, which count twice. ``terms`` is the
    strictest of what was found, NULL if nothing was; licences and labels that are not known are
    ``unknown``. Of the text behind a tag the longest well-formed expression counts: prose behind it
    gives no labels, and a tag without one gives nothing.

    NULL and empty texts have no words and labels. Repeated rows and NULL ids are kept, other columns
    ignored, and an empty table gives no rows.
    """

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(phrases)
        for batch in batches:
            rows = [scanner(x.as_py()) for x in batch.column(1)]
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(_COLUMNS.values())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], [id_column, *_COLUMNS])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column), F.col(text_column).alias("_text")).mapInArrow(
        scan,
        f"`{id_column}` {kind}, n_words long, n_base long, first_word long, last_word long,"
        " base_labels string, labels string, score double, terms string",
    )
