"""URL filters: host and path rules first, then logistic regression on hashed character n-grams.

Everything that touches the pages is DataFrame expressions. The regression is fitted by Spark ML on a
small labelled table of URLs; its coefficients become one constant array of the scoring expression.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 2048
SIZES = (3, 4)

# A small labelled table to learn from is built from these by rule (labelled_urls): names of sites
# that a text corpus wants, and words of which names of sites that it does not want are made.
WANTED = (
    "library", "museum", "news", "docs", "gardening", "university", "recipes", "cityhall", "journal",
    "forum", "wiki", "magazine", "weather", "school", "poems", "history", "physics", "travel", "music",
    "science", "archive", "letters", "health", "nature", "stories", "reader", "theatre", "painting",
    "zeitung", "periodico", "culture", "antiques", "orchestra", "thesis", "notebook", "open-data",
)
UNWANTED = (
    "casino", "poker", "bets", "slots", "jackpot", "win", "free", "cheap", "pills", "pharmacy",
    "adult", "xxx", "porn", "sex", "ads", "track", "click", "spam", "seo", "loans", "crack", "warez",
    "torrent", "replica",
)
_PREFIXES = ("", "www.", "m.", "blog.", "shop.")
_ENDINGS = ("com", "net", "org", "info")
_PATHS = ("/en/4711", "/fr/805.html", "/index.html", "/es/17?page=2", "/de/2023/", "/read/page", "")

Rule = tuple[str, str]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased."""
    host = F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(host, upper, upper.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _split(rule: str) -> tuple[str, str]:
    host, slash, rest = rule.partition("/")
    return host, slash + rest


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct of the longest fitting ``rule`` and its ``action``, or NULL.

    ``rules`` are (action, host and path) pairs, e.g. ("block", "net/fr/"). A rule fits its host and
    all subdomains if the path starts with its path; of equally long ones the first counts. Meant for
    short lists: each rule is one condition.
    """
    found = F.lit(None).cast("struct<rule:string,action:string>")
    for action, rule in sorted(reversed(rules), key=lambda r: len(r[1])):
        own_host, own_path = _split(rule)
        fits = ((host == own_host) | host.endswith(f".{own_host}")) & path.startswith(own_path)
        found = F.when(
            fits, F.struct(F.lit(rule).alias("rule"), F.lit(action).alias("action"))
        ).otherwise(found)
    return found


def gram_buckets(host: Column, path: Column) -> Column:
    """Buckets of the hashed n-grams of host and path, one entry per place."""
    text = F.concat(F.lit("^"), host, path, F.lit("$"))

    def of_size(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length(text) - (n - 1), F.lit(1)))
        return F.transform(
            starts,
            lambda i: F.pmod(F.xxhash64(F.substring(text, i, F.lit(n))), F.lit(BUCKETS)).cast("int"),
        )

    return F.concat(*[of_size(n) for n in SIZES])


@dataclass(frozen=True)
class UrlModel:
    """Logistic regression over n-gram shares; ``score`` is the probability of blocking."""

    weights: tuple[float, ...]
    constant: float

    def score(self, host: Column, path: Column) -> Column:
        # One constant array: a folded cast instead of a thousand literals in the plan.
        weights = F.split(F.lit(",".join(map(repr, self.weights))), ",").cast("array<double>")
        buckets = gram_buckets(host, path)
        total = F.aggregate(
            buckets, F.lit(0.0), lambda s, b: s + F.element_at(weights, b + 1)
        )
        z = F.lit(self.constant) + total / F.sqrt(F.size(buckets))
        return 1 / (1 + F.exp(-z))


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The built-in table: ``url`` and ``label`` (1: block).

    Every name comes with every prefix, while endings and paths go round, so that only the name tells
    the labels apart.
    """
    n = len(UNWANTED)
    bad = [f"{UNWANTED[i]}{'-' * (k > 0)}{UNWANTED[(i + k) % n] * (k > 0)}" for i in range(n) for k in (0, 1, 7)]
    names = [(name, 0) for name in WANTED] + [(name, 1) for name in bad]
    rows = [
        f"('https://{prefix}{name}.example.{_ENDINGS[(i + j) % 4]}{_PATHS[(i + 3 * j) % 7]}', {label})"
        for i, (name, label) in enumerate(names)
        for j, prefix in enumerate(_PREFIXES)
    ]
    return spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t(url, label)")


def fit_urls(
    labelled: DataFrame, regularization: float = 0.0002, allow_weight: float = 8.0
) -> UrlModel:
    """Learn from ``url`` and ``label`` (1: block, 0: allow) of a small table.

    Rows to allow weigh ``allow_weight``, so that names without known n-grams are allowed.

    Rows with a NULL URL or label are left out. Without rows of both labels every URL is allowed,
    or blocked if that is the only label.
    """
    known = labelled.where("url IS NOT NULL AND label IN (0, 1)")
    labels = {r[0] for r in known.select("label").distinct().collect()}
    if len(labels) < 2:
        return UrlModel((0.0,) * BUCKETS, 30.0 if labels == {1} else -30.0)
    buckets = gram_buckets(host_of(F.col("url")), path_of(F.col("url")))
    counted = (
        known.select("url", "label", F.explode(buckets).alias("b"), F.size(buckets).alias("n"))
        .groupBy("url", "label", "n", "b")
        .agg(F.count("*").alias("c"))
        .groupBy("url", "label", "n")
        .agg(F.map_from_entries(F.collect_list(F.struct("b", "c"))).alias("m"))
    )
    share = F.transform(
        F.sequence(F.lit(0), F.lit(BUCKETS - 1)),
        lambda i: F.coalesce(F.element_at("m", i), F.lit(0)) / F.sqrt("n"),
    )
    rows = counted.select(
        array_to_vector(share).alias("features"),
        F.col("label").cast("double").alias("label"),
        F.when(F.col("label") == 0, allow_weight).otherwise(1.0).alias("weight"),
    )
    fitted = LogisticRegression(
        regParam=regularization, standardization=False, maxIter=200, tol=1e-9, weightCol="weight"
    ).fit(rows.coalesce(1).sortWithinPartitions("label", F.hash("features")))
    weights = tuple(round(float(w), 9) for w in fitted.coefficients.toArray())
    return UrlModel(weights, round(float(fitted.intercept), 9))


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    model: UrlModel | None = None,
    id_column: str = "page_id",
    url_column: str = "url",
    threshold: float = 0.5,
) -> DataFrame:
    """Per row: id, ``host``, ``path``, ``rule``, ``verdict`` (allow or block), ``score``.

    The longest fitting rule decides; without one the model does, and blocks from ``threshold`` on.
    ``score`` is the model's probability of blocking for every URL. A NULL URL, or one without
    ``://``, has an empty host and path and is judged by the model. Repeated rows and NULL ids are
    kept, other columns ignored, and an empty table gives no rows.
    """
    model = model or fit_urls(labelled_urls(pages.sparkSession))
    host, path = F.col("host"), F.col("path")
    return (
        pages.select(
            F.col(id_column),
            host_of(F.col(url_column)).alias("host"),
            path_of(F.col(url_column)).alias("path"),
        )
        .select(
            id_column, "host", "path",
            longest_rule(host, path, rules).alias("_rule"),
            model.score(host, path).alias("score"),
        )
        .select(
            id_column, "host", "path",
            F.col("_rule.rule").alias("rule"),
            F.coalesce(
                "_rule.action", F.when(F.col("score") >= threshold, "block").otherwise("allow")
            ).alias("verdict"),
            "score",
        )
    )
