"""Shifts in the amounts of a type from one date to the next, by two-sample tests on value buckets.

Only counts per type, date and bucket leave a task: a bucket holds amounts of one sign that agree in
their number of digits and their first three, so there are some 30,000 at most.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerstrata.columns import DEFAULT, Columns
from ledgerstrata.functions.exprs import asc
from ledgerstrata.sources.scratch import cut_lineage

# Drift: a Kolmogorov-Smirnov distance that chance exceeds once in a thousand equal dates, and a
# population stability index from which a shift is commonly held to be large.
CHANCE = 0.001
LARGE = 0.2


def value_bucket(amount: Column) -> Column:
    """Whole number that never decreases as the amount grows: 1000 times the digits of its cents, and
    the first three of them, with its sign."""
    digits = F.abs(amount * 100).cast("bigint").cast("string")
    lead = F.rpad(F.substring(digits, 1, 3), 3, "0").cast("int")
    return F.signum(amount).cast("int") * (F.length(digits) * 1000 + lead)


def value_counts(silver: DataFrame, c: Columns = DEFAULT) -> DataFrame:
    """Rows per type, date and bucket; rows without amount, type or date do not count. Counts of
    several layers or dates add up."""
    bucket = value_bucket(F.col(c.amount)).alias("bucket")
    known = silver.where(F.col(c.amount).isNotNull() & F.col(c.type).isNotNull() & F.col(c.date).isNotNull())
    return known.groupBy(c.type, c.date, bucket).agg(F.count("*").alias("n"))


def drift(counts: DataFrame, chance: float = CHANCE, large: float = LARGE, c: Columns = DEFAULT) -> DataFrame:
    """One row per type and date with an earlier date of that type: ``previous_date``,
    ``previous_count``, ``record_count``, ``ks``, ``ks_limit``, ``psi`` and ``drifted``.

    ``ks`` is the largest distance of the two shares of amounts up to a bucket, ``psi`` the population
    stability index over sign, digits and first digit, each count raised by a half. A date has drifted
    if ``ks`` exceeds ``ks_limit``, which chance exceeds with probability ``chance`` between large equal
    dates, and ``psi`` is ``large`` or more: very large dates differ surely, but not always much. The
    counts serve several steps; they are stored in the checkpoint folder while the DataFrame is built.
    """
    counts = cut_lineage(counts)
    by_date = Window.partitionBy(c.type).orderBy(c.date)
    dates = (
        counts.groupBy(c.type, c.date)
        .agg(F.sum("n").alias("_total"))
        .withColumns({"_next": F.lead(c.date).over(by_date), "_next_total": F.lead("_total").over(by_date)})
    )
    # A date is the later of its own pair and the earlier of the next one's.
    own = counts.select(c.type, F.col(c.date).alias("_pair"), "bucket", F.lit(0).cast("long").alias("_a"), F.col("n").alias("_b"))
    next_ = counts.join(dates.where("_next IS NOT NULL"), [c.type, c.date]).select(
        c.type, F.col("_next").alias("_pair"), "bucket", F.col("n").alias("_a"), F.lit(0).cast("long").alias("_b")
    )
    pairs = dates.where("_next IS NOT NULL").select(
        c.type, F.col("_next").alias("_pair"), F.col(c.date).alias("previous_date"),
        F.col("_total").alias("_na"), F.col("_next_total").alias("_nb"),
    )
    both = own.unionByName(next_).groupBy(c.type, "_pair", "bucket").agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    upto = Window.partitionBy(c.type, "_pair").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    cumulated = both.withColumns({"_ca": F.sum("_a").over(upto), "_cb": F.sum("_b").over(upto)})
    share = lambda part, whole: F.col(part) / F.col(whole)
    ks = (
        cumulated.join(pairs, [c.type, "_pair"])
        .groupBy(c.type, "_pair", "previous_date", "_na", "_nb")
        .agg(F.round(F.max(F.abs(share("_ca", "_na") - share("_cb", "_nb"))), 9).alias("ks"))
    )
    # Sign, digits and first digit of the bucket.
    coarse = (F.signum("bucket") * F.floor(F.abs("bucket") / 100)).cast("int")
    bins = both.groupBy(c.type, "_pair", coarse.alias("_bin")).agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    shares = bins.withColumn("_bins", F.count("*").over(Window.partitionBy(c.type, "_pair"))).join(pairs, [c.type, "_pair"])
    p, q = [(F.col(n) + 0.5) / (F.col(t) + F.col("_bins") * 0.5) for n, t in (("_a", "_na"), ("_b", "_nb"))]
    psi = shares.groupBy(c.type, "_pair").agg(F.round(F.sum((q - p) * F.ln(q / p)), 6).alias("psi"))
    factor = math.sqrt(-math.log(chance / 2) / 2)
    limit = F.lit(factor) * F.sqrt((F.col("_na") + F.col("_nb")) / (F.col("_na").cast("double") * F.col("_nb")))
    return (
        ks.join(psi, [c.type, "_pair"])
        .withColumn("ks_limit", F.round(limit, 9))
        .select(
            c.type, F.col("_pair").alias(c.date), "previous_date", F.col("_na").alias("previous_count"),
            F.col("_nb").alias("record_count"), "ks", "ks_limit", "psi",
            ((F.col("ks") > F.col("ks_limit")) & (F.col("psi") >= large)).alias("drifted"),
        )
        .orderBy(*asc(c.type, c.date))
    )


def store_results(report: DataFrame, path: str, run: str) -> None:
    """Keep a quality report in the history of results, under the name of its run; a repeated run
    replaces its own. Names sort in the order of the runs, as dates do."""
    (
        report.coalesce(1)  # one row per rule
        .withColumn("run", F.lit(run))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run")
        .parquet(path)
    )


def rule_changes(history: DataFrame) -> DataFrame:
    """Each stored result with ``previous_failing``, that of the run before (NULL in the first), and
    ``worse``: more rows fail than then."""
    before = F.lag("failing").over(Window.partitionBy("layer", "rule").orderBy("run"))
    worse = F.coalesce(F.col("failing") > F.col("previous_failing"), F.lit(False))
    return (
        history.withColumn("run", F.col("run").cast("string"))
        .withColumn("previous_failing", before)
        .withColumn("worse", worse)
    )
