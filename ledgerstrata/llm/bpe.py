"""Byte-pair encoding from a public tokenizer file (``tokenizers`` JSON), and its inverse.

Encoding holds the parts of a word and the merge ranks of adjacent parts in two contiguous arrays:
scan for the least rank, merge there, drop one boundary, refresh the two neighbouring ranks. That is
quickest for short words; words of more than ``_SHORT`` symbols take a heap over linked parts, which
gives the same merges.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstrata.llm.characters import lower, normal, split
from ledgerstrata.llm.text import MEMORY

# Ids take this many bits, which leaves room for vocabularies of a million tokens.
_BITS = 20
_LOW = (1 << _BITS) - 1
_NEVER = 1 << 60
_SHORT = 128
# Chunks of text (a word and what clings to it) that a task remembers; bounds its memory.
_REMEMBERED = 250_000


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies.

    Printable bytes of Latin-1 stand for themselves; the others follow from U+0100 in order.
    """
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


_CHAR = byte_alphabet()
_BYTE = {c: b for b, c in enumerate(_CHAR)}
_TO_CHARS = dict(enumerate(_CHAR))


def as_chars(text: str) -> str:
    """UTF-8 bytes of a text, each as its character of the alphabet."""
    return text.encode("utf-8", "replace").decode("latin-1").translate(_TO_CHARS)


class Bpe:
    """A byte-level BPE vocabulary with its pre-tokenizer.

    Two families of files are read: byte-level (words keep their leading blank), and lower-cased
    words with an end-of-word suffix.
    """

    def __init__(self, content: str):
        spec = json.loads(content)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.special: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token: dict[int, str] = {i: t for t, i in self.vocab.items()}
        self.token |= {i: t for t, i in self.special.items()}
        self.lower = spec["normalizer"] is not None
        split = spec["pre_tokenizer"]
        # The pattern of byte-level files is not in the file but fixed by their kind.
        self.pattern = regex.compile(
            split["pretokenizers"][0]["pattern"]["Regex"] if self.lower else BYTE_LEVEL_PATTERN
        )
        self.byte_decoder = spec["decoder"] is not None
        # For a pair of ids, as one number: its merge rank and, in the low bits, the merged id.
        # The least of several such entries is the one of least rank.
        self.pairs: dict[int, int] = {}
        for r, (left, right) in enumerate(model["merges"]):
            pair = self.vocab[left] << _BITS | self.vocab[right]
            self.pairs[pair] = r << _BITS | self.vocab[left + right]
        self._first = {c: self.vocab[c] for c in _CHAR}
        self._last = {c: self.vocab[c + self.suffix] for c in _CHAR}
        escaped = "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))
        self._special = regex.compile(f"({escaped})") if escaped else None
        self._words: dict[str, list[int]] = {}

    def symbols(self, word: str) -> list[int]:
        """Ids of the single bytes of a pre-token, the last with the end-of-word suffix."""
        chars = word if word.isascii() and word.isalnum() else as_chars(word)
        ids = list(map(self._first.__getitem__, chars))
        ids[-1] = self._last[chars[-1]]
        return ids

    def merge(self, ids: list[int]) -> list[int]:
        """Apply all merges to a list of symbols."""
        if len(ids) > _SHORT:
            return self._merge_long(ids)
        entry = self.pairs.get
        ranks = [entry(a << _BITS | b, _NEVER) for a, b in zip(ids, ids[1:])]
        while ranks:
            least = min(ranks)
            if least == _NEVER:
                break
            i = ranks.index(least)
            ids[i] = new = least & _LOW
            del ids[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = entry(new << _BITS | ids[i + 1], _NEVER)
            if i:
                ranks[i - 1] = entry(ids[i - 1] << _BITS | new, _NEVER)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        entry, end = self.pairs.get, len(ids)
        after, before = list(range(1, end + 1)), list(range(-1, end - 1))
        heap = []
        for i in range(end - 1):
            if (r := entry(ids[i] << _BITS | ids[i + 1])) is not None:
                heap.append((r, i))
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            # Stale entries name a part that is gone or has changed since.
            if ids[i] < 0 or j >= end or entry(ids[i] << _BITS | ids[j]) != r:
                continue
            ids[i], ids[j] = r & _LOW, -1
            after[i] = k = after[j]
            if k < end:
                before[k] = i
            for left, right in ((before[i], i), (i, k)):
                if left >= 0 and right < end:
                    if (q := entry(ids[left] << _BITS | ids[right])) is not None:
                        heapq.heappush(heap, (q, left))
        return [x for x in ids if x >= 0]

    def pre_tokens(self, text: str) -> list[str]:
        return split(self.pattern, lower(normal(text)) if self.lower else text)

    def _word(self, word: str) -> list[int]:
        known = self._words
        ids = known.get(word)
        if ids is None:
            if len(known) > _REMEMBERED:
                known.clear()
            ids = self.merge(self.symbols(word))
            if len(word) <= _SHORT:
                known[word] = ids
        return ids

    def plain_ids(self, text: str) -> list[int]:
        """Encode a text without special strings."""
        return [i for word in self.pre_tokens(text) for i in self._word(word)]

    def pieces(self, text: str) -> Iterator[tuple[str, int | None]]:
        """The text cut at special strings: (text, None) or (special string, its id)."""
        if self._special is None or not any(s in text for s in self.special):
            yield text, None
            return
        for piece in self._special.split(text):
            if piece:
                yield piece, self.special.get(piece)

    def encode(self, text: str | None) -> list[int]:
        """Token ids; special strings in the text become their own ids. NULL counts as empty."""
        out: list[int] = []
        for piece, special in self.pieces(text or ""):
            out += self.plain_ids(piece) if special is None else [special]
        return out

    def decode(self, ids: Iterable[int]) -> str:
        """Text of token ids, special ones included; unknown ids are left out.

        Byte-level files give back the text. Files without a decoder give the tokens joined by
        blanks, as they are in the vocabulary.
        """
        tokens = [self.token[i] for i in ids if i in self.token]
        if not self.byte_decoder:
            return " ".join(tokens)
        out = bytearray()
        for token in tokens:
            if all(c in _BYTE for c in token):
                out += bytes(_BYTE[c] for c in token)
            else:
                out += token.encode()
        return out.decode("utf-8", "replace")


# The split pattern that byte-level files imply.
BYTE_LEVEL_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

_loaded: dict[str, Bpe] = {}


class Shipped:
    """A tokenizer file read once by the driver and sent to each executor once (a few MB).

    Workers keep the parsed vocabulary between tasks.
    """

    def __init__(self, spark: SparkSession, path: str):
        with open(path, encoding="utf-8") as file:
            content = file.read()
        self._digest = hashlib.sha256(content.encode()).hexdigest()
        self._content = spark.sparkContext.broadcast(content)

    def get(self) -> Bpe:
        if self._digest not in _loaded:
            _loaded[self._digest] = Bpe(self._content.value)
        return _loaded[self._digest]


class Encoder:
    """Ids of whole texts. Chunks between blanks are encoded once per memory where a file allows it."""

    def __init__(self, bpe: Bpe):
        self._bpe = bpe
        self._known: dict[str, tuple[int, ...]] = {}
        self._held = 0

    def __call__(self, text: str | None) -> np.ndarray:
        bpe, known = self._bpe, self._known
        if not text or not bpe.lower or any(s in text for s in bpe.special):
            return np.array(bpe.encode(text), np.int32)
        chunks = text.split(" ")
        try:
            found = list(map(known.__getitem__, chunks))
        except KeyError:
            if len(known) > _REMEMBERED or self._held > MEMORY:
                known.clear()
                self._held = 0
            for chunk in set(chunks).difference(known):
                known[chunk] = tuple(bpe.plain_ids(chunk))
                self._held += len(chunk)
            found = list(map(known.__getitem__, chunks))
        return np.fromiter(chain.from_iterable(found), np.int32)


def encode_documents(
    docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The id, ``n_tokens`` and ``ids`` (array of int) of every row, as ``Bpe.encode`` gives them.

    NULL and empty texts have no tokens; repeated rows and NULL ids are kept; other columns are
    ignored; an empty table gives no rows.
    """
    shipped = Shipped(docs.sparkSession, path)

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shipped.get())
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids = [encoder(text) for text in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(map(len, ids), pa.int64()),
                        pa.array(ids, pa.list_(pa.int32())),
                    ],
                    [id_column, "n_tokens", "ids"],
                )

    taken = docs.select(F.col(id_column), F.col(text_column).alias("_text"))
    kind = docs.schema[id_column].dataType.simpleString()
    return taken.mapInArrow(encode, f"`{id_column}` {kind}, n_tokens long, ids array<int>")


def decode_ids(ids: DataFrame, path: str, id_column: str = "doc_id") -> DataFrame:
    """``id_column`` and ``text`` of ``ids`` for every row; NULL ids give NULL."""
    shipped = Shipped(ids.sparkSession, path)

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = shipped.get()
        for batch in batches:
            texts = [x if x is None else bpe.decode(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], [id_column, "text"]
            )

    kind = ids.schema[id_column].dataType.simpleString()
    return ids.select(id_column, "ids").mapInArrow(decode, f"`{id_column}` {kind}, text string")


class Digester:
    """Token ids and decoded text of whole texts as one string each.

    Pre-tokens of lower-casing files never span a blank, so a text is cut at blanks and each chunk
    is encoded and decoded once per memory; of a chunk the two strings it adds are kept. Other files
    and special strings take the plain way.
    """

    def __init__(self, bpe: Bpe):
        self._bpe = bpe
        self._known: dict[str, tuple[str, str]] = {"": ("", "")}
        self._older: dict[str, tuple[str, str]] = {}
        self._held = 0
        self._number = {i: f"{i} " for i in bpe.token}
        self._token = {i: f"{t} " for i, t in bpe.token.items()}

    def _learn(self, chunks: set[str]) -> None:
        """Remember new chunks; of the older ones only those that are still in use."""
        if len(self._known) > _REMEMBERED // 2 or self._held > MEMORY:
            self._known, self._older = {"": ("", "")}, self._known if self._held <= MEMORY else {}
            self._held = 0
        known, older = self._known, self._older
        encode, number, token = self._bpe.plain_ids, self._number, self._token
        for chunk in chunks.difference(known):
            entry = older.get(chunk)
            if entry is None:
                ids = encode(chunk)
                entry = "".join([number[i] for i in ids]), "".join([token[i] for i in ids])
            known[chunk] = entry
            self._held += len(chunk)

    def __call__(self, text: str | None) -> tuple[str, str]:
        """Ids in decimal, and the decoded text."""
        bpe = self._bpe
        text = text or ""
        if not bpe.lower or bpe.byte_decoder or any(s in text for s in bpe.special):
            ids = bpe.encode(text)
            return " ".join(map(str, ids)), bpe.decode(ids)
        chunks = text.split(" ")
        try:
            entries = list(map(self._known.__getitem__, chunks))
        except KeyError:
            self._learn(set(chunks))
            entries = list(map(self._known.__getitem__, chunks))
        return "".join([e[0] for e in entries])[:-1], "".join([e[1] for e in entries])[:-1]


def encoded_digests(
    docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of every row, without storing the ids.

    The hashes are of the decimal ids joined by one blank and of the decoded text. NULL and empty
    texts have no tokens and the hash of nothing.
    """
    shipped = Shipped(docs.sparkSession, path)

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digester = Digester(shipped.get())
        sha = lambda s: hashlib.sha256(s.encode("utf-8", "replace")).hexdigest()
        for batch in batches:
            counts, ids_sha, text_sha = [], [], []
            for text in batch.column(1).to_pylist():
                ids, decoded = digester(text)
                counts.append(ids.count(" ") + 1 if ids else 0)
                ids_sha.append(sha(ids))
                text_sha.append(sha(decoded))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha), pa.array(text_sha)],
                [id_column, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column), F.col(text_column).alias("_text")).mapInArrow(
        digest,
        f"`{id_column}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )
