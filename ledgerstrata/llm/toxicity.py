"""Toxicity by two class-conditional Kneser-Ney models over the letters of words.

Each class has an interpolated Kneser-Ney model of letter n-grams within words; the lowest orders are
continuation counts that both classes share, so an expression that is rare in both is predicted alike
by both and says nothing. A word counts once per document, in training and in scoring: repeating a
word does not change a score. What is compared are log-likelihoods per distinct word, over the whole
text and for its most telling words; a logistic curve fitted on rows kept back from the models turns
them into a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstrata.llm.text import released
from ledgerstrata.sources.scratch import cut_lineage

ORDER = 5
# Orders up to this one use counts of both classes together.
SHARED = 2
# At most so many labelled rows of each class are learned from.
SAMPLE_ROWS = 2000
# Words whose log ratio is above this count as telling.
_TELLING = 3.0
_START, _END = "\x02", "\x03"
_WORD = re.compile(r"[^\W\d_]+")
_REMEMBERED = 100_000


def distinct_words(text: str | None) -> set[str]:
    """Lower-case runs of letters. NULL has none."""
    return set(_WORD.findall(text.lower())) if text else set()


@dataclass
class KneserNey:
    """Discounted shares of n-grams and back-off weights of their contexts, order by order."""

    share: dict[str, float] = field(default_factory=dict)
    weight: dict[str, float] = field(default_factory=dict)

    @classmethod
    def of(cls, counts: Counter) -> KneserNey:
        """``counts``: n-grams of the highest order, and shorter ones only at the start of a word."""
        levels: dict[int, Counter] = defaultdict(Counter)
        for gram, n in counts.items():
            levels[len(gram)][gram] += n
        for order in range(max(levels, default=1), 1, -1):
            # Continuation count: how many different letters stand before the shorter n-gram.
            levels[order - 1].update(gram[1:] for gram in levels[order])
        model = cls()
        for level in levels.values():
            once = sum(1 for n in level.values() if n == 1)
            twice = sum(1 for n in level.values() if n == 2)
            discount = once / (once + 2 * twice) if once and twice else 0.5
            total, kinds = Counter(), Counter()
            for gram, n in level.items():
                total[gram[:-1]] += n
                kinds[gram[:-1]] += 1
            for gram, n in level.items():
                model.share[gram] = max(n - discount, 0.0) / total[gram[:-1]]
            for context, n in kinds.items():
                model.weight[context] = discount * n / total[context]
        return model


class LogRatio:
    """log p(word | toxic) - log p(word | ordinary)."""

    def __init__(self, toxic: Counter, ordinary: Counter):
        self._classes = (KneserNey.of(toxic), KneserNey.of(ordinary))
        self._shared = KneserNey.of(toxic + ordinary)
        letters = {gram[-1] for counts in (toxic, ordinary) for gram in counts}
        self._floor = 1.0 / (len(letters) + 1)
        self._grams: dict[str, float] = {}
        self._words: dict[str, float] = {}

    def _log(self, model: KneserNey, gram: str) -> float:
        p, rest = 0.0, 1.0
        for start in range(len(gram)):
            source = model if len(gram) - start > SHARED else self._shared
            part = gram[start:]
            p += rest * source.share.get(part, 0.0)
            rest *= source.weight.get(part[:-1], 1.0)
        return math.log(p + rest * self._floor)

    def _gram(self, gram: str) -> float:
        if len(self._grams) > _REMEMBERED:
            self._grams.clear()
        toxic, ordinary = self._classes
        value = self._grams[gram] = self._log(toxic, gram) - self._log(ordinary, gram)
        return value

    def __call__(self, word: str) -> float:
        value = self._words.get(word)
        if value is None:
            if len(self._words) > _REMEMBERED:
                self._words.clear()
            known, value = self._grams, 0.0
            marked = f"{_START}{word}{_END}"
            for end in range(2, len(marked) + 1):
                gram = marked[max(0, end - ORDER) : end]
                ratio = known.get(gram)
                value += self._gram(gram) if ratio is None else ratio
            if len(word) < 64:
                self._words[word] = value
        return value

    def features(self, words: set[str]) -> tuple[float, float, float]:
        """Mean log ratio of the words, mean over telling words only, and the largest one."""
        if not words:
            return 0.0, 0.0, 0.0
        # math.fsum: the order of a set differs from task to task.
        ratios = list(map(self, words))
        telling = math.fsum(r for r in ratios if r > _TELLING)
        return math.fsum(ratios) / len(ratios), telling / len(ratios), max(ratios)


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Coefficients (constant first) by Newton steps; ``ridge`` keeps them finite."""
    x = np.column_stack([np.ones(len(x)), x])
    b = np.zeros(x.shape[1])
    penalty = np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        gradient = x.T @ (weight * (y - p)) - penalty @ b
        step = np.linalg.solve((x.T * (weight * p * (1 - p) + 1e-9)) @ x + penalty, gradient)
        b = b + step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-8:
            break
    return b


@dataclass
class ToxicityModel:
    """What ``score_documents`` needs; its size is bounded by the labelled rows learned from."""

    toxic: dict[str, int]
    ordinary: dict[str, int]
    coefficients: list[float]
    constant: float | None = None

    def scorer(self):
        if self.constant is not None:
            return lambda text: self.constant
        ratio = LogRatio(Counter(self.toxic), Counter(self.ordinary))
        b = self.coefficients

        def score(text: str | None) -> float:
            x = ratio.features(distinct_words(text))
            z = b[0] + sum(c * v for c, v in zip(b[1:], squeeze(x)))
            return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))

        return score


def squeeze(x: tuple[float, float, float]) -> tuple[float, float, float]:
    """Bring the features to comparable ranges; few words make means large."""
    return math.tanh(x[0]), math.sqrt(x[1]), x[2] / 10


def _words_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, text in enumerate(batch.column(2).to_pylist()):
            words = list(distinct_words(text))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([batch.column(0)[i].as_py()] * len(words), pa.int32()),
                    pa.array([batch.column(1)[i].as_py()] * len(words), pa.bool_()),
                    pa.array(words, pa.string()),
                ],
                ["_toxic", "_kept_back", "_word"],
            )


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    sample_rows: int = SAMPLE_ROWS,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
) -> ToxicityModel:
    """Learn from ``docs`` (id, text) whose id has a label 0 or 1 in ``labels`` (id, label).

    A bounded sample is enough to learn from: the ``sample_rows`` documents of each class whose ids
    have the least hashes. They are chosen from ids alone, so no text is shuffled. A third of them,
    again by hash, fits the logistic curve and is kept out of the models. NULL labels and ids are left
    out; of conflicting labels the larger counts. With labels of one class only, or none, every score
    is the share of toxic labels (0 without labels). Counts are made by Spark; the driver gets n-gram
    counts of the sample.
    """
    known = (
        labels.select(F.col(id_column).cast("string").alias("_id"), F.col(label_column).alias("_toxic"))
        .where(F.col("_id").isNotNull() & F.col("_toxic").isin(0, 1))
        .groupBy("_id")
        .agg(F.max("_toxic").cast("int").alias("_toxic"))
    )
    rows = docs.select(F.col(id_column).cast("string").alias("_id"), F.col(text_column).alias("_text"))
    present = known.join(rows.select("_id"), "_id", "left_semi")
    totals = {r[0]: r[1] for r in present.groupBy("_toxic").count().collect()}
    if len(totals) < 2:
        return ToxicityModel({}, {}, [], float(1 in totals))
    by_hash = F.xxhash64("_id"), F.col("_id")
    ids = [
        present.where(F.col("_toxic") == k).orderBy(*by_hash).limit(sample_rows) for k in (0, 1)
    ]
    # At most two times sample_rows ids.
    sample = rows.join(F.broadcast(cut_lineage(ids[0].union(ids[1]))), "_id")
    kept_back = F.pmod(F.xxhash64("_id", F.lit("kept back")), F.lit(3)) == 0
    words = sample.select("_toxic", kept_back.alias("_kept_back"), "_text").mapInArrow(
        _words_of, "_toxic int, _kept_back boolean, _word string"
    )
    counted = words.where("NOT _kept_back").groupBy("_toxic", "_word").count()
    marked = F.concat(F.lit(_START), F.col("_word"), F.lit(_END))
    end = F.explode(F.sequence(F.lit(2), F.length("_marked"))).alias("_end")
    grams = (
        counted.select("_toxic", marked.alias("_marked"), "count")
        .select("_toxic", "_marked", "count", end)
        .select(
            "_toxic",
            F.substring(
                F.col("_marked"),
                F.greatest(F.col("_end") - (ORDER - 1), F.lit(1)),
                F.least(F.col("_end"), F.lit(ORDER)),
            ).alias("_gram"),
            "count",
        )
        .groupBy("_toxic", "_gram")
        .agg(F.sum("count").alias("_n"))
    )
    counts: dict[int, dict[str, int]] = {0: {}, 1: {}}
    for row in grams.toLocalIterator():
        counts[row[0]][row[1]] = row[2]
    model = ToxicityModel(counts[1], counts[0], [])
    features = sample.where(kept_back).select("_toxic", "_text").mapInArrow(
        _featurizer(model), "_toxic int, a double, b double, c double"
    )
    seen = sorted(tuple(r) for r in features.collect())
    y = np.array([r[0] for r in seen], float)
    if not 0 < y.sum() < len(y):
        return ToxicityModel({}, {}, [], totals[1] / (totals[0] + totals[1]))
    x = np.array([squeeze(r[1:]) for r in seen])
    share = {k: totals[k] / max(1, (y == k).sum()) for k in (0, 1)}
    weight = np.where(y == 1, share[1], share[0])
    model.coefficients = fit_logistic(x, y, weight * len(y) / weight.sum()).tolist()
    return model


def _featurizer(model: ToxicityModel):
    def features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = LogRatio(Counter(model.toxic), Counter(model.ordinary))
        for batch in batches:
            x = [ratio.features(distinct_words(t)) for t in batch.column(1).to_pylist()]
            columns = [pa.array([v[i] for v in x], pa.float64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["_toxic", "a", "b", "c"])

    return features


def score_documents(
    docs: DataFrame, model: ToxicityModel, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``id_column`` and ``score`` (0 to 1, higher: more likely toxic) of every row's whole text.

    NULL and empty texts, and texts without letters, get the score of no evidence. Repeated rows and
    NULL ids are kept, other columns ignored, and an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared.value.scorer()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                scores = [scorer(text) for text in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(scores, pa.float64())], [id_column, "score"]
                )

    schema = T.StructType([docs.schema[id_column], T.StructField("score", T.DoubleType())])
    texts = docs.select(F.col(id_column), F.col(text_column).alias("_text"))
    return texts.mapInArrow(lambda batches: released(score(batches)), schema)


def mild_documents(
    docs: DataFrame, model: ToxicityModel, below: float = 0.7, text_column: str = "text"
) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is less than ``below``; nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared.value.scorer()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = part.column(text_column).to_pylist()
                yield part.filter(pa.array([scorer(t) < below for t in texts], pa.bool_()))

    return docs.mapInArrow(lambda batches: released(keep(batches)), docs.schema)


def held_out(modulus: int, remainder: int, id_column: str = "doc_id"):
    """Whether crc32 of the id as text leaves ``remainder``; never for a NULL id."""
    crc = F.crc32(F.col(id_column).cast("string").cast("binary"))
    return F.coalesce(crc % modulus == remainder, F.lit(False))
