"""Registered queries: statements where SQL can express them, columns, and the pipeline."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
import corpus_pipeline
from checks.compare import _rows
from ledgerstrata.llm import oracle
from ledgerstrata.llm.decontam import benchmark_overlaps
from ledgerstrata.llm.near_dup import near_duplicates
from ledgerstrata.llm.queries import QUERIES
from ledgerstrata.llm.quality import quality_verdicts
from ledgerstrata.llm.toxicity import fit_toxicity, score_documents


@pytest.mark.parametrize("name", list(oracle.SQL))
def test_equals_statement(name, spark, sf_dir, duck):
    df = QUERIES[name](spark, sf_dir)
    cursor = duck.execute(oracle.SQL[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert _rows(df.columns, df.collect()) == _rows(columns, cursor.fetchall())


def test_all_are_registered():
    names = set(spark_entry.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES}


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("_key", F.lit("extra"))
    odd = docs.limit(1).withColumns({"lang": F.lit(None).cast("string"), "doc_id": F.lit(None).cast("long")})
    docs = docs.unionByName(odd).unionByName(docs.where("doc_id = 4"))
    tables = {"input": docs}
    for name, stage in corpus_pipeline.STAGES:
        path = corpus_pipeline.scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        tables[name] = docs = spark.read.parquet(path)
    return tables


def test_stages_keep_what_their_operators_keep(spark, sf_dir, stages):
    ids = {name: {r.doc_id for r in t.select("doc_id").collect()} for name, t in stages.items()}
    for name in ("quality", "toxicity", "near_dedup", "decontamination"):
        assert stages[name].columns == stages["input"].columns
        assert stages[name].where("_key <> 'extra'").count() == 0
    judged = {r.doc_id for r in quality_verdicts(stages["input"]).where("kept").collect()}
    assert ids["quality"] == judged
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit_toxicity(stages["quality"], labels)
    mild = {r.doc_id for r in score_documents(stages["quality"], model).where("score < 0.7").collect()}
    assert ids["toxicity"] == mild
    kept = {r.doc_id for r in near_duplicates(stages["toxicity"]).where("kept").collect()}
    assert ids["near_dedup"] - {None} == kept - {None}
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    hit = {r.doc_id for r in benchmark_overlaps(stages["near_dedup"], benchmark).collect()}
    assert ids["decontamination"] == ids["near_dedup"] - hit
    assert ids["encoding"] == ids["decontamination"]
    assert stages["encoding"].columns == ["doc_id", "n_tokens", "ids"]
    assert stages["encoding"].where(F.size("ids") != F.col("n_tokens")).count() == 0


def test_an_empty_table_passes_through(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        path = corpus_pipeline.scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    assert docs.count() == 0
