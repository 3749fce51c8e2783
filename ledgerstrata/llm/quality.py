"""Quality rules: fixed base rules, and robust multivariate outliers per language and source.

Each document becomes a vector of transformed statistics. For each language and source a minimum
covariance determinant estimate is computed over all its documents: from medians and median
deviations, concentration steps keep the half of the rows that lie nearest and take their mean and
covariance again, until nothing changes; so junk does not enter before it is half of all rows. Where
many rows are copies of one text, that half is narrower than the rest: reweighting steps then take all
rows within the 0.975 quantile, again until nothing changes. Documents far from the estimate by
Mahalanobis distance are rejected.

A step is one aggregation: rows are counted by distance bucket, and the sums of a bucket are sums of
whole numbers, so neither the order of tasks nor lost executors change a result, and a source with a
third of all rows costs each task one row per bucket. Vectors are stored once and do not move in a
step: the estimates, one row per group, are sent to them (up to ``SENT_ROWS`` groups; more are joined
by a shuffle). Estimates of a step are stored in as few files: Hadoop's local file system starts a
process or more for each file, which for a moment shares, and seems to double, an executor's memory.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstrata.llm.text import WordHasher, mix, released
from ledgerstrata.sources.scratch import drop_scratch, scratch_path

_BLANKS = b" \t\n\v\f\r"
_SYMBOLS = b"#*$%&|<>"
# ASCII punctuation; fixed values.
_MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())

# Values are kept in whole thousandths.
_UNIT = 1000
# Statistics of the vector, each with the spread below which it is not taken to vary: a statistic
# that is the same for most documents of a source must not turn small deviations into large ones.
_FLOORS = {
    "log_words": 0.30,
    "log_word_length": 0.06,
    "symbols": 0.06,
    "marks": 0.07,
    "capitals": 0.08,
    "dup_lines": 0.20,
    "repeats": 0.16,
}
KEPT_SHARE = 0.5
REWEIGHTED_SHARE = 0.975
MIN_ROWS = 50
CONFIDENCE = 0.99999
# Rows of estimates or group names, of some hundred bytes each, that are sent to all executors at once.
SENT_ROWS = 10_000
_BUCKETS_PER_E = 16
_STEPS = 12


class Counter:
    """Counts of one text."""

    NAMES = (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
        "n_marks", "n_capitals",
    )

    def __init__(self):
        self._hash = WordHasher(200_000)

    def __call__(self, text: str | None) -> tuple[int, ...]:
        if not text:
            return (0,) * len(self.NAMES)
        data = text.encode("utf-8", "replace")
        words = data.split()
        lines = [line for line in data.split(b"\n") if line.strip(_BLANKS)]
        without = lambda chars: len(data) - len(data.translate(None, chars))
        capitals = without(_CAPITALS)
        return (
            len(words),
            len(text) - without(_BLANKS),
            without(_SYMBOLS),
            len(lines) - len(set(lines)),
            self._repeated(words),
            len(lines),
            without(_MARKS),
            capitals if len(text) == len(data) else sum(map(str.isupper, text)),
        )

    def _repeated(self, words: list[bytes]) -> int:
        """Words that lie in a run of three words that occurs at least twice."""
        if len(words) < 4:
            return 0
        w = self._hash(words)
        runs = mix(mix(w[:-2]) + w[1:-1])
        runs = mix(runs + w[2:])
        _, inverse, count = np.unique(runs, return_inverse=True, return_counts=True)
        twice = count[inverse] > 1
        covered = np.zeros(len(words), bool)
        for i in range(3):
            covered[i : len(words) - 2 + i] |= twice
        return int(covered.sum())


_CAPITALS = bytes(range(65, 91))


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counter = Counter()
    for batch in batches:
        counts = [counter(x.as_py()) for x in batch.column("_text")]
        kept = [batch.column(n) for n in ("_id", "_lang", "_source")]
        numbers = [pa.array([c[i] for c in counts], pa.int64()) for i in range(len(Counter.NAMES))]
        yield pa.RecordBatch.from_arrays(
            [*kept, *numbers], ["_id", "_lang", "_source", *Counter.NAMES]
        )


def _vector() -> Column:
    """The statistics in whole thousandths, from the counts. Documents without words give zeros."""
    words = F.greatest("n_words", F.lit(1))
    chars = F.greatest("word_chars", F.lit(1))
    share = lambda part, whole: F.sqrt(F.col(part) / whole)
    values = {
        "log_words": F.log(words),
        "log_word_length": F.log(chars / words),
        "symbols": share("n_symbols", chars),
        "marks": share("n_marks", chars),
        "capitals": share("n_capitals", chars),
        "dup_lines": share("n_dup_lines", F.greatest("n_lines", F.lit(1))),
        "repeats": share("n_repeat_words", words),
    }
    return F.array(*[F.round(values[n] * _UNIT).cast("long") for n in _FLOORS])


def chi_square(share: float, freedom: int) -> float:
    """Quantile of the chi-square distribution (Wilson and Hilferty)."""
    z = NormalDist().inv_cdf(share)
    return freedom * (1 - 2 / (9 * freedom) + z * math.sqrt(2 / (9 * freedom))) ** 3


_P = len(_FLOORS)
_PAIRS = [(i, j) for i in range(_P) for j in range(i, _P)]
_FLOOR = np.array(list(_FLOORS.values()))
_PARAMS = "_group string, _rows long, _centre array<double>, _precision array<double>, _scale double"


def _params(group: str, rows: int, centre: np.ndarray, cov: np.ndarray, scale: float) -> pd.DataFrame:
    precision = np.linalg.inv(cov + np.diag(_FLOOR**2))
    flat = [float(precision[i, j]) * (1 if i == j else 2) for i, j in _PAIRS]
    return pd.DataFrame(
        {
            "_group": [group],
            "_rows": [rows],
            "_centre": [[round(float(c), 9) for c in centre]],
            "_precision": [[round(v, 9) for v in flat]],
            "_scale": [scale],
        }
    )


def _start(counts: pd.DataFrame) -> pd.DataFrame:
    """Medians and median deviations of each statistic, from how often each value occurs."""

    def median(values: np.ndarray, n: np.ndarray) -> float:
        order = np.argsort(values, kind="stable")
        return values[order][np.searchsorted(n[order].cumsum(), (n.sum() + 1) // 2)]

    centre, spread = [], []
    for _, part in sorted(counts.groupby("_k")):
        values, n = part["_value"].to_numpy() / _UNIT, part["_n"].to_numpy()
        centre.append(median(values, n))
        spread.append(1.4826 * median(np.abs(values - centre[-1]), n))
    rows = int(counts.loc[counts["_k"] == 0, "_n"].sum())
    return _params(counts["_group"].iloc[0], rows, np.array(centre), np.diag(np.square(spread)), 1.0)


def _step(sums: pd.DataFrame, reweighted: bool) -> pd.DataFrame:
    """Mean and covariance of the nearest rows, from the sums of each distance bucket.

    They are the nearest ``KEPT_SHARE`` of the rows or, ``reweighted``, all rows that are no farther
    than ``REWEIGHTED_SHARE`` of a normal sample.
    """
    sums = sums.sort_values("_bucket")
    n = sums["_n"].to_numpy()
    rows = int(n.sum())
    upto = n.cumsum()
    middle = int(np.searchsorted(upto, (rows + 1) // 2))
    median = math.exp((sums["_bucket"].iloc[middle] + 0.5) / _BUCKETS_PER_E)
    scale = max(1.0, median / chi_square(0.5, _P))
    share = REWEIGHTED_SHARE if reweighted else KEPT_SHARE
    cut = chi_square(share, _P)
    if reweighted:
        farthest = math.floor(math.log(scale * cut) * _BUCKETS_PER_E)
        last = int(np.searchsorted(sums["_bucket"].to_numpy(), farthest, side="right")) - 1
    else:
        last = int(np.searchsorted(upto, math.ceil(share * rows)))
    near, total = sums.iloc[: last + 1], int(upto[last])
    x = np.array([int(near[f"_s{i}"].sum()) for i in range(_P)], dtype=float)
    cov = np.empty((_P, _P))
    for i, j in _PAIRS:
        both = int(near[f"_s{i}_{j}"].sum())
        # Whole numbers of any size: no digits are lost in the difference.
        top = both * total - int(near[f"_s{i}"].sum()) * int(near[f"_s{j}"].sum())
        cov[i, j] = cov[j, i] = top / total**2
    # The nearest rows vary less than all rows do; this brings a normal sample back to its spread.
    cov *= share / _chi_share(cut, _P + 2) / _UNIT**2
    return _params(sums["_group"].iloc[0], rows, x / total / _UNIT, cov, scale)


def _steps(reweighted: bool) -> Callable[[pd.DataFrame], pd.DataFrame]:
    return lambda sums: _step(sums, reweighted)


def _chi_share(value: float, freedom: int) -> float:
    """Share of the chi-square distribution below a value: the inverse of ``chi_square``."""
    z = ((value / freedom) ** (1 / 3) - 1 + 2 / (9 * freedom)) / math.sqrt(2 / (9 * freedom))
    return NormalDist().cdf(z)


def _distance() -> Column:
    """Squared Mahalanobis distance of ``_x`` from ``_centre``."""
    d = [F.col("_x")[i] / _UNIT - F.col("_centre")[i] for i in range(_P)]
    terms = [F.col("_precision")[k] * d[i] * d[j] for k, (i, j) in enumerate(_PAIRS)]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return F.greatest(total, F.lit(0.0))


def _stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """A table, written and read again, and its path; partitions without rows leave no file."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _sent(rows: int) -> Callable[[DataFrame], DataFrame]:
    """How tables of so many rows are joined: sent to all executors if they are few."""
    return F.broadcast if rows <= SENT_ROWS else lambda other: other


def robust_estimates(vectors: DataFrame, steps: int = _STEPS) -> DataFrame:
    """Reweighted minimum covariance determinant estimate of ``_x`` for each ``_group``, over all rows.

    Columns: ``_group``, ``_rows``, ``_centre``, ``_precision`` (inverse covariance, upper triangle
    with doubled off-diagonal entries) and ``_scale`` (squared distances of the middle row against
    those of a normal sample). Each step reads ``vectors`` again and stores one small row per group in
    scratch storage; estimates of earlier steps are deleted.
    """
    spark = vectors.sparkSession
    values = vectors.select("_group", F.posexplode("_x").alias("_k", "_value"))
    counts = values.groupBy("_group", "_k", "_value").agg(F.count("*").alias("_n"))
    params, path = _stored(counts.groupBy("_group").applyInPandas(_start, _PARAMS), "estimates")
    n_groups = params.count()
    sent, files = _sent(n_groups), max(1, math.ceil(n_groups / SENT_ROWS))
    sums = [F.sum(F.col("_x")[i]).alias(f"_s{i}") for i in range(_P)] + [
        F.sum(F.col("_x")[i] * F.col("_x")[j]).alias(f"_s{i}_{j}") for i, j in _PAIRS
    ]
    bucket = F.floor(F.log(_distance() + 1e-6) * _BUCKETS_PER_E).cast("int")
    for reweighted in (False, True):
        for _ in range(steps):
            counted = (
                vectors.join(sent(params), "_group")
                .withColumn("_bucket", bucket)
                .groupBy("_group", "_bucket")
                .agg(F.count("*").alias("_n"), *sums)
            )
            moved = counted.groupBy("_group").applyInPandas(_steps(reweighted), _PARAMS)
            moved, moved_path = _stored(moved.repartition(files), "estimates")
            before = params.select("_group", "_rows", "_centre", "_precision")
            settled = moved.join(sent(before), before.columns, "left_anti").isEmpty()
            drop_scratch(spark, path)
            params, path = moved, moved_path
            if settled:
                break
    return params


def quality_verdicts(
    docs: DataFrame,
    min_rows: int = MIN_ROWS,
    confidence: float = CONFIDENCE,
    id_column: str = "doc_id",
) -> DataFrame:
    """Counts and verdict of every row of ``docs`` (id, text, lang, source).

    Columns: the id, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``base_failed``, ``distance`` (squared Mahalanobis distance, NULL where no
    estimate applies) and ``kept``. Base rules fail below 50 words, or if more than half of the words
    lie in a repeated run of three. Other documents are rejected if their distance is beyond the
    ``confidence`` quantile. Estimates use documents that pass the base rules. Sources with fewer
    than ``min_rows`` of them share one estimate per language; where these are too few as well, only
    the base rules decide.

    NULL, empty and blank texts have counts of 0 and fail. A NULL language or source is a value like
    any other. Repeated rows are each counted and returned; other columns are ignored; an empty
    table gives no rows.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "statistics")
    numbers = [T.StructField(n, T.LongType()) for n in Counter.NAMES]
    schema = T.StructType(
        [
            T.StructField("_id", docs.schema[id_column].dataType),
            T.StructField("_lang", T.StringType()),
            T.StructField("_source", T.StringType()),
            *numbers,
        ]
    )
    docs.select(
        F.col(id_column).alias("_id"),
        F.col("lang").cast("string").alias("_lang"),
        F.col("source").cast("string").alias("_source"),
        F.col("text").alias("_text"),
    ).mapInArrow(lambda batches: released(_count(batches)), schema).write.parquet(path)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    counted = (
        spark.read.parquet(path)
        .withColumn("base_failed", failed)
        .withColumn("_own", F.to_json(F.struct("_lang", "_source")))
    )
    sizes = counted.where("NOT base_failed").groupBy("_own", "_lang").agg(F.count("*").alias("_n"))
    groups = sizes.select(
        "_own",
        F.when(F.col("_n") >= min_rows, F.col("_own"))
        .otherwise(F.to_json(F.struct("_lang", F.lit(True).alias("_small"))))
        .alias("_group"),
    )
    groups, _ = _stored(groups, "groups")
    sent = _sent(groups.count())
    vectors, vectors_path = _stored(
        counted.where("NOT base_failed").join(sent(groups), "_own").select("_group", _vector().alias("_x")),
        "vectors",
    )
    estimates = robust_estimates(vectors).where(F.col("_rows") >= min_rows)
    drop_scratch(spark, vectors_path)
    known = groups.join(sent(estimates), "_group").drop("_group", "_rows")
    limit = chi_square(confidence, _P)
    distance = F.when(~F.col("base_failed"), F.round(_distance() / F.col("_scale"), 6))
    return (
        counted.withColumn("_x", _vector())
        .join(sent(known), "_own", "left")
        .select(
            F.col("_id").alias(id_column),
            *Counter.NAMES[:5],
            "base_failed",
            distance.alias("distance"),
            (~F.col("base_failed") & F.coalesce(distance <= limit, F.lit(True))).alias("kept"),
        )
    )
