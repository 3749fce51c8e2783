"""Exact token counts of every prefix of a text, by dynamic programming over prefixes.

A BPE encoding is the only split of a word into tokens in which every two neighbours encode to
themselves. So the encoding of a prefix is that of a shorter prefix plus one token, and that token is
the only one that fits the last token before it. One pass over the bytes of a word thus gives the
token count of each of its prefixes, and truncation and budget questions need no second encoding.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerstrata.llm.bpe import _BITS, _LOW, _SHORT, Bpe, Shipped, as_chars
from ledgerstrata.llm.text import MEMORY

_PAIRS = 1_000_000
# Length of the beginnings that words share.
_STEM = 6
# Words, and chunks of text, that a task remembers.
_REMEMBERED = 500_000
# Where a blank stands beside other white space or at an end, pre-tokens may span it.
_BLANKS = re.compile(r"^\s|\s\Z| \s|\s ")


def _blank(text: str) -> bool:
    """White space as the split pattern sees it: without the four separators U+001C to U+001F."""
    return text.isspace() and not any("\x1c" <= c <= "\x1f" for c in text)


class PrefixCounter:
    """Counts of all prefixes for a byte-level vocabulary without end-of-word suffix."""

    def __init__(self, bpe: Bpe):
        if bpe.suffix or bpe.lower:
            raise ValueError("prefix counts need a byte-level vocabulary without word ends")
        self._bpe = bpe
        self._longest = max(map(len, bpe.vocab))
        # Rank at which each token is made, and the two tokens it is made of; bytes come first.
        self._made: dict[int, int] = {}
        self._parts: dict[int, tuple[int, int]] = {}
        for pair, entry in bpe.pairs.items():
            self._made.setdefault(entry & _LOW, entry >> _BITS)
            self._parts.setdefault(entry & _LOW, (pair >> _BITS, pair & _LOW))
        self._fits: dict[int, bool] = {}
        self._alone: dict[int, bool] = {}
        self._words: dict[str, list[int]] = {}
        self._stems: dict[str, tuple[list[int], list[int]]] = {}
        self._chunks: dict[str, int] = {}
        self._older: dict[str, int] = {}
        self._held = 0

    def _stands_alone(self, token: int) -> bool:
        """Whether the bytes of a token encode to that token."""
        known = self._alone.get(token)
        if known is None:
            symbols = [self._bpe.vocab[c] for c in self._bpe.token[token]]
            known = self._alone[token] = self._bpe.merge(symbols) == [token]
        return known

    def _neighbours(self, left: int, right: int) -> bool:
        """Whether two tokens, side by side, stay as they are.

        Undo merges on both sides of the boundary from the latest to the earliest. The two tokens
        merge into something else if at some time the parts that touch could merge across the
        boundary before the next merge that did happen beside it.
        """
        made, parts, pairs = self._made, self._parts, self._bpe.pairs
        next_left = next_right = 1 << 60
        while True:
            across = pairs.get(left << _BITS | right)
            # On equal rank the leftmost pair goes first: a merge inside the left token wins over
            # the boundary, the boundary wins over a merge inside the right token.
            if across is not None:
                across >>= _BITS
                if across < next_left and across <= next_right:
                    return False
            undo_left, undo_right = made.get(left, -1), made.get(right, -1)
            if undo_left < 0 and undo_right < 0:
                return True
            if undo_left > undo_right or (undo_left == undo_right and undo_right >= 0):
                # The right-hand merge of equal rank happened later only if it is not the left one.
                if undo_left == undo_right:
                    right, next_right = parts[right][0], undo_right
                else:
                    left, next_left = parts[left][1], undo_left
            else:
                right, next_right = parts[right][0], undo_right

    def _fit(self, left: int, right: int) -> bool:
        """As ``_neighbours``, remembered; the right token must also encode to itself."""
        if len(self._fits) > _PAIRS:
            self._fits.clear()
        fit = self._stands_alone(right) and self._neighbours(left, right)
        self._fits[left << _BITS | right] = fit
        return fit

    def _word(self, chars: str) -> list[int]:
        """Token counts of the prefixes of 1, 2, ... bytes of one pre-token."""
        # The prefixes of a prefix do not depend on what follows: words share their beginnings.
        stem = chars[:_STEM]
        known = self._stems.get(stem)
        if known is None:
            if len(self._stems) > _REMEMBERED:
                self._stems.clear()
            known = self._stems[stem] = self._extend([], [], stem)
        if len(chars) <= _STEM:
            return known[1]
        return self._extend(known[0].copy(), known[1].copy(), chars)[1]

    def _extend(self, last: list[int], counts: list[int], chars: str) -> tuple[list, list]:
        """Append last token and count of each further prefix of ``chars``."""
        get, fits, longest = self._bpe.vocab.get, self._fits, self._longest
        for end in range(len(counts) + 1, len(chars) + 1):
            # Exactly one token ends this prefix; short ones are the most frequent.
            for start in range(end - 1, max(-1, end - 1 - longest), -1):
                token = get(chars[start:end])
                if token is None:
                    continue
                if not start:
                    if self._stands_alone(token):
                        last.append(token)
                        counts.append(1)
                        break
                    continue
                left = last[start - 1]
                fit = fits.get(left << _BITS | token)
                if fit is None:
                    fit = self._fit(left, token)
                if fit:
                    last.append(token)
                    counts.append(counts[start - 1] + 1)
                    break
        return last, counts

    def word_counts(self, word: str) -> list[int]:
        known = self._words
        counts = known.get(word)
        if counts is None:
            if len(known) > _REMEMBERED:
                known.clear()
            counts = self._word(as_chars(word))
            if len(word) <= _SHORT:
                known[word] = counts
        return counts

    def _count_chunk(self, chunk: str) -> int:
        return sum(self.word_counts(word)[-1] for word in self._bpe.pre_tokens(chunk))

    def _plain_chunks(self, text: str) -> list[str]:
        """Cut a text where its pre-tokens cannot span: before a blank between two other characters."""
        parts = text.split(" ")
        chunks = [parts[0], *[" " + p for p in parts[1:]]]
        if not _BLANKS.search(text):
            return chunks
        groups: list[list[str]] = [[chunks[0]]]
        for part, chunk in zip(parts[1:], chunks[1:]):
            last = groups[-1][-1]
            if last[-1:].isspace() or not last or not part or part[0].isspace():
                groups[-1].append(chunk)
            else:
                groups.append([chunk])
        return ["".join(g) for g in groups]

    def _learn(self, chunks: set[str]) -> None:
        """Remember new chunks; of the older ones only those that are still in use."""
        if len(self._chunks) > _REMEMBERED // 2 or self._held > MEMORY:
            self._chunks, self._older = {}, self._chunks if self._held <= MEMORY else {}
            self._held = 0
        known, older = self._chunks, self._older
        for chunk in chunks.difference(known):
            n = older.get(chunk)
            known[chunk] = self._count_chunk(chunk) if n is None else n
            self._held += len(chunk)

    def _chunk_counts(self, text: str) -> Iterator[tuple[str, int]]:
        for piece, special in self._bpe.pieces(text):
            if special is not None:
                yield piece, 1
                continue
            chunks = self._plain_chunks(piece)
            self._learn(set(chunks))
            yield from zip(chunks, map(self._chunks.__getitem__, chunks))

    def count(self, text: str | None) -> int:
        """Tokens of a whole text; special strings are one token each."""
        if not text:
            return 0
        if any(s in text for s in self._bpe.special):
            return sum(n for _, n in self._chunk_counts(text))
        chunks = self._plain_chunks(text)
        try:
            return sum(map(self._chunks.__getitem__, chunks))
        except KeyError:
            self._learn(set(chunks))
            return sum(map(self._chunks.__getitem__, chunks))

    def prefix_counts(self, text: str | None) -> list[int]:
        """Entry k - 1: tokens of the first k characters, encoded by themselves.

        A special string that is cut counts as ordinary text; so does white space at a cut, which
        a following word would otherwise have taken its last blank from.
        """
        out: list[int] = []
        total = 0
        base, before = 0, ""
        for piece, special in self._bpe.pieces(text or ""):
            if special is not None:
                cut = self._plain_prefixes(before + piece)[len(before) : -1]
                out += [base + n for n in cut] + [total + 1]
                total += 1
                base, before = total, ""
            else:
                base, before = total, piece
                out += [total + n for n in self._plain_prefixes(piece)]
                total = out[-1] if out else 0
        return out

    def _plain_prefixes(self, text: str) -> list[int]:
        out: list[int] = []
        total, place = 0, 0
        blank_from, before_blank = -1, 0
        for word in self._bpe.pre_tokens(text):
            counts = self.word_counts(word)
            # Counts at the ends of characters, which have one to four bytes.
            ends = list(accumulate(len(c.encode("utf-8", "replace")) for c in word))
            own = [total + counts[e - 1] for e in ends]
            if word[0] == "'" and len(word) == 3 and word[1:].isalpha():
                # A cut contraction such as 'r is a quote and a letter, not one pre-token.
                own[1] = total + self.word_counts("'")[-1] + self.word_counts(word[1])[-1]
            if _blank(word):
                if blank_from < 0:
                    blank_from, before_blank = place, total
                run = text[blank_from : place + len(word)]
                at = self._run_counts(run)
                own = [before_blank + n for n in at[place - blank_from :]]
            elif word[0] == " " and blank_from >= 0:
                run = text[blank_from : place + 1]
                own[0] = before_blank + self._run_counts(run)[-1]
            if not _blank(word):
                blank_from = -1
            out += own
            total += counts[-1]
            place += len(word)
        return out

    def _run_counts(self, run: str) -> list[int]:
        counts = self.word_counts(run)
        return [counts[e - 1] for e in accumulate(len(c.encode()) for c in run)]

    def fitting(self, text: str | None, budget: int) -> int:
        """Length in characters of the longest prefix of at most ``budget`` tokens.

        Special strings are never cut.
        """
        text = text or ""
        total = place = 0
        start, base = 0, 0
        for chunk, n in self._chunk_counts(text):
            # The last chunk that begins below the budget holds the cut.
            if total >= budget:
                break
            start, base = place, total
            place += len(chunk)
            total += n
        else:
            if total <= budget:
                return len(text)
        fits = [k for k, n in enumerate(self.prefix_counts(text[start:place]), 1) if base + n <= budget]
        return start + max(fits, default=0)


def token_counts(
    docs: DataFrame,
    path: str,
    limit: int = 1024,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Per row: id, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit``, ``chars_in_limit``.

    ``n_tokens`` is the count of the whole text as the tokenizer library gives it, special strings
    in the text as one token each. ``chars_in_limit`` is the length of the longest prefix that has
    at most ``limit`` tokens. NULL and empty texts count 0. Repeated rows and NULL ids are kept,
    other columns ignored, and an empty table gives no rows.
    """
    shipped = Shipped(docs.sparkSession, path)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(shipped)
        for batch in batches:
            sizes, counts, fits = [], [], []
            for text in batch.column(1).to_pylist():
                n = counter.count(text)
                sizes.append(len(text.encode("utf-8", "replace")) if text else 0)
                counts.append(n)
                fits.append(len(text or "") if n <= limit else counter.fitting(text, limit))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array([n > limit for n in counts], pa.bool_()),
                    pa.array(fits, pa.int64()),
                ],
                [id_column, "n_bytes", "n_tokens", "over_limit", "chars_in_limit"],
            )

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column), F.col(text_column).alias("_text")).mapInArrow(
        count,
        f"`{id_column}` {kind}, n_bytes long, n_tokens long, over_limit boolean,"
        " chars_in_limit long",
    )


def prefix_token_counts(
    docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``counts``: the token count of every prefix, one entry per character of the text."""
    shipped = Shipped(docs.sparkSession, path)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(shipped)
        for batch in batches:
            counts = [counter.prefix_counts(text) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.list_(pa.int32()))], [id_column, "counts"]
            )

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column), F.col(text_column).alias("_text")).mapInArrow(
        count, f"`{id_column}` {kind}, counts array<int>"
    )


def _counter(shipped: Shipped) -> PrefixCounter:
    bpe = shipped.get()
    if not hasattr(bpe, "prefix_counter"):
        bpe.prefix_counter = PrefixCounter(bpe)
    return bpe.prefix_counter
