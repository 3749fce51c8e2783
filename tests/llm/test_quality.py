"""Base rules against DuckDB and robust estimates against planted outliers."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerstrata.llm import quality
from ledgerstrata.llm.quality import quality_verdicts, robust_estimates

BASE = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), runs AS (
  SELECT doc_id, i, words[i:i + 2] AS run
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)
), twice AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, run) AS n FROM runs) WHERE n > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(0, 3) t(k) GROUP BY doc_id
)
SELECT w.doc_id, len(words), coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT,
  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')), len(lines) - len(list_distinct(lines)),
  coalesce(covered.n, 0)
FROM w LEFT JOIN covered USING (doc_id)
"""


@pytest.fixture(scope="module")
def judged(spark, sf_dir):
    return quality_verdicts(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()


def test_base_counts_equal_sql(judged, duck):
    want = {r[0]: r[1:] for r in duck.execute(BASE).fetchall()}
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert {r.doc_id: tuple(r[n] for n in names) for r in judged} == want
    for r in judged:
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed and not (failed and r.kept)


def numpy_estimate(x, steps=12):
    """The same estimate over plain rows: nearest halves, then reweighting, ranked by distance bucket."""
    p, middle = x.shape[1], (len(x) + 1) // 2 - 1
    centre = np.sort(x, axis=0)[middle]
    spread = 1.4826 * np.sort(np.abs(x - centre), axis=0)[middle]
    cov, scale = np.diag(spread**2), 1.0
    for share in (0.5, 0.975):
        cut = quality.chi_square(share, p)
        for _ in range(steps):
            inverse = np.linalg.inv(cov + np.diag(quality._FLOOR**2))
            d = np.einsum("ij,jk,ik->i", x - centre, inverse, x - centre)
            bucket = np.floor(np.log(d + 1e-6) * 16)
            ranked = np.sort(bucket)
            scale = max(1.0, np.exp((ranked[middle] + 0.5) / 16) / quality.chi_square(0.5, p))
            half = ranked[int(np.ceil(0.5 * len(x))) - 1]
            near = x[bucket <= (half if share == 0.5 else np.floor(np.log(scale * cut) * 16))]
            centre = near.mean(axis=0)
            cov = np.cov(near.T, bias=True) * share / quality._chi_share(cut, p + 2)
    return centre, np.linalg.inv(cov + np.diag(quality._FLOOR**2)), scale


def test_estimates_resist_a_fifth_of_outliers(spark):
    rng = np.random.default_rng(31)
    good = rng.normal(0, 1, (2000, 7)) * [1, 0.5, 0.2, 0.2, 0.1, 0.1, 0.3] + 2
    bad = rng.normal(9, 0.2, (500, 7))
    x = np.round(np.concatenate([good, bad]) * 1000).astype(int)
    df = spark.createDataFrame([("g", r.tolist()) for r in x], "_group string, _x array<long>")
    row = robust_estimates(df.repartition(7)).first()
    again = robust_estimates(df.repartition(3)).first()
    assert row == again
    assert np.allclose(row._centre, 2, atol=0.1)
    centre, inverse, scale = numpy_estimate(x / 1000)
    flat = [inverse[i, j] * (1 if i == j else 2) for i, j in quality._PAIRS]
    assert np.allclose(row._centre, centre, atol=1e-6) and np.isclose(row._scale, scale)
    assert np.allclose(row._precision, flat, rtol=1e-5, atol=1e-5)
    assert row._rows == 2500


def tasks_of(spark, call):
    """Tasks that Spark ran for a call."""
    context, group = spark.sparkContext, f"tasks-{random.random()}"
    context.setJobGroup(group, "counted")
    call()
    context.setLocalProperty("spark.jobGroup.id", None)
    context._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    seen = context.statusTracker()
    stages = {s for j in seen.getJobIdsForGroup(group) for s in seen.getJobInfo(j).stageIds}
    return sum(i.numCompletedTasks for s in stages if (i := seen.getStageInfo(s)))


def test_a_step_shuffles_sums_only(spark):
    """Vectors stay where they are and estimates are sent to them: two shuffles a step, of sums."""
    rng = np.random.default_rng(35)
    rows = [("g" if i % 3 else "h", r.tolist()) for i, r in enumerate(rng.integers(0, 3000, (600, 7)))]
    vectors = spark.createDataFrame(rows, "_group string, _x array<long>").repartition(2).localCheckpoint()
    conf = {
        "spark.sql.shuffle.partitions": "40",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        tasks = tasks_of(spark, lambda: robust_estimates(vectors, steps=2))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert tasks <= 5 * (2 * 40 + 20)


def test_estimates_of_a_step_lie_in_one_file(spark, monkeypatch):
    """Each file costs processes that share an executor's memory, however many partitions there are."""
    rng = np.random.default_rng(37)
    rows = [(f"g{i % 12}", r.tolist()) for i, r in enumerate(rng.integers(0, 3000, (600, 7)))]
    vectors = spark.createDataFrame(rows, "_group string, _x array<long>")
    files, drop = [], quality.drop_scratch

    def counted(session, path):
        files.append(len(session.read.parquet(path).inputFiles()))
        return drop(session, path)

    monkeypatch.setattr(quality, "drop_scratch", counted)
    conf = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        last = robust_estimates(vectors, steps=3)
        files.append(len(last.inputFiles()))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert last.count() == 12
    assert len(files) >= 3 and set(files[1:]) == {1}


def test_more_groups_than_are_sent_give_the_same(spark, monkeypatch):
    rng = np.random.default_rng(36)
    rows = [(f"g{i % 5}", r.tolist()) for i, r in enumerate(rng.integers(0, 3000, (500, 7)))]
    vectors = spark.createDataFrame(rows, "_group string, _x array<long>")
    sent = sorted(robust_estimates(vectors).collect())
    monkeypatch.setattr(quality, "SENT_ROWS", 4)
    assert sorted(robust_estimates(vectors).collect()) == sent and len(sent) == 5


def test_junk_is_rejected_and_prose_is_kept(spark, vocabulary):
    rng = random.Random(32)
    rows = []
    for i in range(400):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(60, 600))]
        if i % 20 == 7:
            words = [w.upper() + "%%%" for w in words]
        rows.append((i, " ".join(words), "en", "a" if i % 3 else "b"))
    got = quality_verdicts(
        spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    ).collect()
    assert {r.doc_id for r in got if not r.kept} == {i for i in range(400) if i % 20 == 7}


@pytest.mark.parametrize("kind", ["copies of junk", "mixed junk", "copies of prose"])
def test_a_third_of_a_group(spark, vocabulary, kind):
    rng = random.Random(34)
    prose = lambda: [rng.choice(vocabulary) for _ in range(rng.randint(60, 600))]
    rows = [(i, " ".join(prose()), "en", "a") for i in range(300)]
    one = " ".join(prose() if "prose" in kind else [w.upper() + "%%%" for w in prose()])
    for i in range(300, 450):
        marked = " ".join(w.upper() + "%" * rng.randint(1, 6) for w in prose())
        rows.append((i, marked if "mixed" in kind else one, "en", "a"))
    got = quality_verdicts(
        spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    ).collect()
    junk = set() if "prose" in kind else set(range(300, 450))
    assert {r.doc_id for r in got if not r.kept} == junk


def test_odd_documents(odd_docs):
    got = quality_verdicts(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by_id = {r.doc_id: r for r in got}
    assert [by_id[i].n_words for i in (1, 2, 3)] == [0, 0, 0]
    assert by_id[5].n_repeat_words == 30_000 and by_id[6].n_words == 1
    assert not any(r.kept for r in got)
    assert quality_verdicts(odd_docs.limit(0)).count() == 0


def test_small_groups_are_judged_by_base_rules_only(spark, vocabulary):
    rng = random.Random(33)
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(80)), None, None) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = quality_verdicts(docs)
    assert got.where("kept").count() == 5 and got.where(F.col("distance").isNull()).count() == 5
