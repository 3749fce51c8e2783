"""Language of texts by the nearest of several centroids per language.

A text becomes a normalised TF-IDF vector of hashed n-grams of one to three bytes of its lower-case
words. The vectors of a language's sample are clustered on the sphere, and a text gets the language of
the centroid with the largest cosine. Texts farther from it than nearly all of its own sample are
marked as rejected.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKETS_LOG2 = 12
# At most so many rows of each language are learned from.
SAMPLE_ROWS = 400
# At most so many rows of all languages together.
MAX_ROWS = 10_000
CENTROIDS = 4
# Slack added to the largest distance that a language's own sample shows.
_SLACK = 0.15

# ASCII letters and all bytes of other characters are kept, everything else becomes a blank.
_LETTERS = np.array([c if 97 <= c <= 122 or c > 127 else 32 for c in range(256)], np.uint32)
_SPREAD = np.uint32(0x9E3779B1)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def gram_counts(text: str) -> np.ndarray:
    """How often each bucket of hashed 1- to 3-byte n-grams occurs; words are set off by blanks."""
    data = np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8)
    b = _LETTERS[data]
    b = b[np.concatenate([[True], (b[1:] != 32) | (b[:-1] != 32)])]
    two = (b[:-1] << np.uint32(8)) | b[1:]
    three = (two[:-1] << np.uint32(8)) | b[2:]
    grams = np.concatenate([b, two + np.uint32(1 << 25), three + np.uint32(1 << 26)])
    return np.bincount((grams * _SPREAD) >> np.uint32(32 - BUCKETS_LOG2), minlength=1 << BUCKETS_LOG2)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


@dataclass
class LanguageModel:
    """Weights and centroids; the size depends on the number of languages only."""

    idf: np.ndarray
    centroids: np.ndarray
    languages: list[str]
    reach: np.ndarray

    def vectors(self, texts: list[str]) -> np.ndarray:
        counts = np.array([gram_counts(t) for t in texts], np.float32)
        return _unit(np.log1p(counts) * self.idf)

    def predict(self, texts: list[str]) -> list[tuple[str, float, bool]]:
        """Language, cosine (0 to 1) and whether the text is too far away, for texts with letters."""
        if not texts:
            return []
        if not self.languages:
            return [("und", 0.0, True)] * len(texts)
        cosine = self.vectors(texts) @ self.centroids.T
        best = cosine.argmax(axis=1)
        value = cosine[np.arange(len(best)), best]
        return [
            (self.languages[i], float(min(1.0, max(0.0, v))), bool(v < self.reach[i]))
            for i, v in zip(best, value)
        ]


def _clusters(rows: np.ndarray, k: int, rounds: int = 20) -> np.ndarray:
    """Spherical k-means; the first centroids lie far from each other. Nothing is random."""
    mean = _unit(rows.mean(axis=0, keepdims=True))
    chosen = [int((rows @ mean[0]).argmax())]
    while len(chosen) < min(k, len(rows)):
        chosen.append(int((rows @ rows[chosen].T).max(axis=1).argmin()))
    centroids = rows[chosen]
    for _ in range(rounds):
        nearest = (rows @ centroids.T).argmax(axis=1)
        moved = [rows[nearest == i].mean(axis=0) for i in range(len(centroids)) if (nearest == i).any()]
        centroids = _unit(np.array(moved))
    return centroids


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lang, id_, text in zip(*[c.to_pylist() for c in batch.columns]):
            counts = gram_counts(text)
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang]),
                    pa.array([id_], pa.string()),
                    pa.array([at.astype(np.uint16).tobytes()], pa.binary()),
                    pa.array([counts[at].astype(np.float32).tobytes()], pa.binary()),
                ],
                ["_lang", "_id", "_at", "_count"],
            )


def fit_language(
    docs: DataFrame,
    sample_rows: int = SAMPLE_ROWS,
    centroids: int = CENTROIDS,
    max_rows: int = MAX_ROWS,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
) -> LanguageModel:
    """Learn from the rows of ``docs`` that have a language and a text with letters.

    A bounded sample is enough: per language the ``sample_rows`` rows whose ids have the least hashes,
    and ``max_rows`` of them in all, equally many of each language. Texts are not shuffled for it.
    Without any such row the model knows no language and calls every text ``und``.
    """
    letter = F.regexp_like(F.col("_text"), F.lit(r"\p{L}"))
    rows = docs.select(
        F.col(lang_column).cast("string").alias("_lang"),
        F.col(id_column).cast("string").alias("_id"),
        F.col(text_column).alias("_text"),
    ).where(F.col("_lang").isNotNull() & F.col("_id").isNotNull())
    by_hash = Window.partitionBy("_lang").orderBy(F.xxhash64("_id"), "_id")
    # A limit per language applies in each task before the shuffle.
    chosen = (
        rows.where(letter).select("_lang", "_id")
        .withColumn("_place", F.row_number().over(by_hash))
        .where(F.col("_place") <= sample_rows)
        .orderBy("_place", "_lang")
        .limit(max_rows)
        .select("_lang", "_id")
        .distinct()
    )
    sample = (
        rows.where(letter)
        .join(F.broadcast(chosen), ["_lang", "_id"], "left_semi")  # at most max_rows rows
        .select("_lang", "_id", "_text")
        .mapInArrow(_counted, "_lang string, _id string, _at binary, _count binary")
        .collect()
    )
    seen = sorted(
        sample, key=lambda r: (r["_lang"], r["_id"], bytes(r["_at"]), bytes(r["_count"]))
    )
    size = 1 << BUCKETS_LOG2
    if not seen:
        none = np.zeros((0, size), np.float32)
        return LanguageModel(np.zeros(size, np.float32), none, [], np.zeros(0))
    counts = np.zeros((len(seen), size), np.float32)
    for i, row in enumerate(seen):
        counts[i, np.frombuffer(row["_at"], np.uint16)] = np.frombuffer(row["_count"], np.float32)
    idf = np.log((1 + len(seen)) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + 1
    vectors = _unit(np.log1p(counts) * idf)
    names = np.array([r["_lang"] for r in seen])
    found, languages, reach = [], [], []
    for name in sorted(set(names)):
        own = vectors[names == name]
        middle = _clusters(own, centroids)
        cosine = own @ middle.T
        nearest = cosine.argmax(axis=1)
        for i in range(len(middle)):
            mine = cosine[nearest == i, i]
            reach.append((mine.min() if len(mine) else 1.0) - _SLACK)
        found.append(middle)
        languages += [name] * len(middle)
    return LanguageModel(
        idf, np.concatenate(found).astype(np.float32), languages, np.array(reach)
    )


def predict_language(
    docs: DataFrame, model: LanguageModel, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per row: id, ``lang_pred``, ``score`` (cosine, 0 to 1) and ``rejected``.

    ``lang_pred`` is the nearest learned language even where ``rejected`` says that it is far; a
    NULL text, or one without any letter, is ``und`` with score 0 and not rejected. Repeated rows
    and NULL ids are kept, other columns ignored, and an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                texts = part.column(1).to_pylist()
                known = [i for i, t in enumerate(texts) if has_letter(t)]
                rows = [("und", 0.0, False)] * len(texts)
                for i, found in zip(known, model.predict([texts[i] for i in known])):
                    rows[i] = found
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([r[0] for r in rows], pa.string()),
                        pa.array([r[1] for r in rows], pa.float64()),
                        pa.array([r[2] for r in rows], pa.bool_()),
                    ],
                    [id_column, "lang_pred", "score", "rejected"],
                )

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column), F.col(text_column).alias("_text")).mapInArrow(
        predict, f"`{id_column}` {kind}, lang_pred string, score double, rejected boolean"
    )
