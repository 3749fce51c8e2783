"""Joins with hot and missing keys, against plain joins and brute force."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerstrata.operators import reconcile
from ledgerstrata.plans import jobs
from ledgerstrata.plans.quality import quality_report
from ledgerstrata.sources.scratch import cut_lineage

from .conftest import rows

ROWS = 30_000


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows share one id, half of them exact copies; a tenth have no id."""
    n = F.col("id")
    return spark.range(0, ROWS, 1, 12).select(
        F.when(n % 30 < 10, "hot")
        .when(n % 30 < 13, None)
        .otherwise(F.concat(F.lit("k"), (n % 9000).cast("string")))
        .alias("transaction_id"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id % 30 % 5)").alias(
            "booked_at"
        ),
        F.when(n % 30 < 5, 1).otherwise(n % 7).cast("decimal(18,2)").alias("amount"),
        F.when(n % 11 == 0, "FEE").otherwise("fee").alias("transaction_type"),
        F.expr("date'2024-01-01' + cast(id % 3 as int)").alias("booked_date"),
    )


@pytest.fixture
def small_parts(spark):
    """Shuffle joins, and skew handling at the size of the test data."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    }
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def largest_task(df):
    per_task = df.groupBy(F.spark_partition_id().alias("task")).count()
    return per_task.agg(F.max("count")).first()[0]


def test_hot_and_missing_ids_are_spread(hot, small_parts):
    """No join task receives much more than its share, though a third of the rows share an id."""
    silver = cut_lineage(jobs.clean_silver(hot).where("transaction_id LIKE 'k1%'"))
    missing = reconcile.recon_missing_in_silver(hot, silver)
    assert largest_task(missing) < 2.5 * ROWS / 8


def test_a_hot_id_on_the_right_is_spread(spark, hot, small_parts):
    left = hot.where("transaction_id <> 'hot'").union(
        hot.where("transaction_id = 'hot'").limit(1)
    )
    wide = hot.withColumn("amount", F.lit(99).cast("decimal(18,2)"))
    pairs = reconcile.recon_amount_discrepancy(left, wide.where("transaction_id = 'hot'"))
    assert pairs.count() == ROWS // 3
    assert largest_task(pairs) < 0.6 * ROWS / 3


def test_many_hot_ids_on_both_sides(spark):
    """1,500 ids of twenty rows on both sides: every count equals that of single pairs."""
    n = F.col("id")
    both = spark.range(0, 30_000).select(
        F.concat(F.lit("k"), (n % 1500).cast("string")).alias("transaction_id"),
        F.lit(None).cast("timestamp_ntz").alias("booked_at"),
        (n % 2).cast("decimal(18,2)").alias("amount"),
        F.when(n % 3 == 0, "fee").otherwise("payment").alias("transaction_type"),
        F.lit("2024-01-01").cast("date").alias("booked_date"),
    )
    silver = both.withColumn("amount_valid", F.lit(True))
    plain = both.alias("b").join(both.alias("s"), "transaction_id")
    matched = plain.groupBy("b.transaction_type").count()
    assert sorted(rows(reconcile.matched_by_type(both, silver))) == sorted(rows(matched))
    mismatch = (
        plain.where("b.transaction_type <> s.transaction_type")
        .groupBy("b.transaction_type", "s.transaction_type")
        .count()
    )
    assert sorted(rows(reconcile.recon_type_mismatch(both, silver))) == sorted(rows(mismatch))
    coverage = rows(reconcile.silver_coverage(both, silver))
    assert [r[1:3] for r in coverage] == [(plain.count(), plain.count())]
    assert reconcile.recon_amount_discrepancy(both, silver).count() == plain.where("b.amount <> s.amount").count()
    report = {r[1]: r[2] for r in rows(quality_report(both, silver, jobs.build_gold(silver)))}
    assert report["amount_kept"] == plain.where("b.amount <> s.amount").count()


@pytest.mark.parametrize(
    "operator", [reconcile.matched_by_type, reconcile.recon_type_mismatch, reconcile.silver_coverage]
)
def test_both_sides_are_counted_before_they_are_joined(operator, stored):
    text = operator(stored.bronze, stored.silver)._jdf.queryExecution().executedPlan().toString()
    assert text.count("partial_count") == 2 and text.index("Join") < text.index("partial_count")


def test_checks_and_jobs_on_hot_ids(hot):
    bronze = [tuple(r) for r in hot.collect()]
    latest = {}
    for id_, at, amount, kind, day in bronze:
        if id_ is not None:
            place = (at, amount, [-ord(ch) for ch in kind], day)
            latest[id_] = max(latest.get(id_, place), place, key=lambda p: p)
    silver = jobs.clean_silver(hot)
    assert silver.count() == len(latest)
    kept = {r[0]: (r[1], r[2]) for r in silver.select("transaction_id", "booked_at", "amount").collect()}
    assert kept == {k: v[:2] for k, v in latest.items()}

    rejected = jobs.rejected_rows(hot).groupBy("reason").agg(F.sum("copies"))
    no_id = sum(r[0] is None for r in bronze)
    assert dict(rows(rejected)) == {
        "missing_id": no_id,
        "duplicate": ROWS - no_id - len(latest),
    }

    differing = sum(1 for r in bronze if r[0] is not None and r[2] != latest[r[0]][1])
    assert reconcile.recon_amount_discrepancy(hot, silver).count() == differing
    matched = dict(rows(reconcile.matched_by_type(hot, silver)))
    assert matched == Counter(r[3] for r in bronze if r[0] is not None)
    per_day = {day: {r[0] for r in bronze if r[4] == day} - {None} for day in {r[4] for r in bronze}}
    some = silver.where("transaction_id = 'hot' OR amount > 2")
    held = {r[0] for r in some.select("transaction_id").collect()}
    assert rows(reconcile.recon_layer_counts(hot, some)) == [
        (day.isoformat(), len(ids), len(ids & held), len(ids - held))
        for day, ids in sorted(per_day.items())
    ]
    missing = reconcile.recon_missing_in_silver(hot, silver.where("transaction_id <> 'hot'"))
    assert missing.count() == sum(r[0] in (None, "hot") for r in bronze)
