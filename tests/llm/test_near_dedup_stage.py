"""The near-duplicate stage of the corpus pipeline, where ids do not name rows."""

from pyspark.sql import functions as F

import corpus_pipeline


def test_each_row_follows_its_own_verdict(spark, sf_dir, vocabulary):
    a, b, c, d = (" ".join(vocabulary[i : i + 60]) for i in (0, 100, 200, 300))
    rows = [(1, a, "s"), (2, a, "s"), (2, b, "s"), (3, b, "s")]
    rows += [(None, c, "s"), (None, c, "t"), (None, c, "u"), (None, d, "s"), (9, d, "s"), (9, d, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = corpus_pipeline.near_dedup(spark, docs, sf_dir).collect()
    assert {(r.doc_id, r.text) for r in got} == {(1, a), (2, b), (None, c), (9, d)}
    assert len(got) == 4


def test_repeated_rows_do_not_multiply(spark, sf_dir, vocabulary):
    """20,000 equal rows beside others, with a map column: no join makes more rows than came in."""
    a, b = (" ".join(vocabulary[i : i + 60]) for i in (0, 100))
    rows = spark.range(20_000).selectExpr("5L AS doc_id", f"'{a}' AS text", "map('k', array(1)) AS extra")
    rows = rows.union(spark.sql(f"SELECT 4L, '{a} more', map('k', array(2)) UNION ALL SELECT 6L, '{b}', NULL"))
    docs = rows.withColumn("_key", F.lit(1)).withColumn("component_id", F.lit(1))
    got = corpus_pipeline.near_dedup(spark, docs, sf_dir)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == [4, 6]
    made = joined_rows(got._jdf.queryExecution().executedPlan())
    assert made and max(made) <= 20_002


def joined_rows(plan):
    """Rows that each join of an executed plan made."""
    name = plan.nodeName()
    if name.startswith("AdaptiveSparkPlan"):
        return joined_rows(plan.executedPlan())
    if "QueryStage" in name:
        return joined_rows(plan.plan())
    found = [plan.metrics().apply("numOutputRows").value()] if "Join" in name else []
    for i in range(plan.children().size()):
        found += joined_rows(plan.children().apply(i))
    return found


def test_hashes_shared_by_chance_are_told_apart(spark, monkeypatch):
    docs = spark.range(6).selectExpr("id AS doc_id", "concat('t', id div 2) AS text", "id % 2 AS source")
    real = F.xxhash64

    def weak(first, *rest):
        """As if rows of one text shared the first hash."""
        return real("text") if str(first) == str(F.lit(1)) else real(first, *rest)

    monkeypatch.setattr(corpus_pipeline.F, "xxhash64", weak)
    keyed, key = corpus_pipeline._numbered(docs)
    assert keyed.select(key).distinct().count() == 6
    assert [c for c in keyed.columns if c != key] == docs.columns
