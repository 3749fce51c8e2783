"""The corpus pipeline: from raw documents to token ids, one written table per stage.

Stages take (spark, docs, sf_dir) and return a DataFrame; all but the last return the columns of
``docs``. Each works on everything its predecessor kept. NULL texts and texts without words fall at the
quality stage; a NULL language or source is a value like any other; extra columns of any type are
carried along up to the last stage. An empty table passes through all stages as an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstrata.llm.bpe import encode_documents
from ledgerstrata.llm.decontam import benchmark_overlaps
from ledgerstrata.llm.near_dup import near_duplicates
from ledgerstrata.llm.quality import quality_verdicts
from ledgerstrata.llm.shipping import make_importable
from ledgerstrata.llm.toxicity import fit_toxicity, mild_documents
from ledgerstrata.sources.scratch import scratch_path

TOXIC_FROM = 0.7


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _row_key(*columns: str) -> Column:
    """Text that differs where the columns differ, NULL included: equal rows get equal verdicts."""
    cols = [F.col(c) for c in columns]
    return F.concat_ws(
        ":",
        F.coalesce(F.col("doc_id").cast("string"), F.lit("none")),
        F.xxhash64(*cols, *[c.isNull() for c in cols]).cast("string"),
    )


def _keyed(docs: DataFrame, *columns: str) -> tuple[DataFrame, str]:
    """Documents with a row key, under a name that no column of theirs has."""
    name = "_key"
    while name in docs.columns:
        name += "_"
    return docs.withColumn(name, _row_key(*columns)), name


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go (operator 8)."""
    make_importable(spark)
    keyed, key = _keyed(docs, "text", "lang", "source")
    rejected = quality_verdicts(keyed, id_column=key).where("NOT kept").select(key).distinct()
    return keyed.join(rejected, key, "left_anti").select(*docs.columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of 0.7 or more go (operator 3); they are not shuffled for it."""
    make_importable(spark)
    model = fit_toxicity(docs, _table(spark, sf_dir, "labels"))
    return mild_documents(docs, model, below=TOXIC_FROM)


def _hashable(docs: DataFrame) -> list[Column]:
    """All columns in a form that can be hashed; maps, also inner ones, as JSON."""
    kinds = dict(docs.dtypes)
    return [
        F.to_json(F.struct(c)) if "map<" in kinds[c] else F.col(c) for c in docs.columns
    ]


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """Documents with a number that only repeated rows share, and its name.

    The number is a 64-bit hash of all columns. Of ten billion rows about three pairs are expected to
    share one by chance; a second hash finds them, and these rows (a list that grows with the square
    of the rows over 2^65) get a number made of both.
    """
    name = "_key"
    while name in docs.columns or f"{name}_2" in docs.columns:
        name += "_"
    second = f"{name}_2"
    cols = _hashable(docs)
    hashes = [F.xxhash64(F.lit(seed), *cols, *[c.isNull() for c in cols]) for seed in (1, 2)]
    keyed = docs.withColumns({name: hashes[0], second: hashes[1]})
    by_chance = (
        keyed.groupBy(name)
        .agg(F.min(second).alias("a"), F.max(second).alias("b"))
        .where("a <> b")
        .select(name)
    )
    shared = [r[0] for r in by_chance.collect()]
    if shared:
        both = F.when(F.col(name).isin(shared), F.xxhash64(name, second)).otherwise(F.col(name))
        keyed = keyed.withColumn(name, both)
    return keyed.drop(second), name


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one of least id (operator 9).

    Groups are found between rows, named by a hash of all columns, so that each row follows its own
    verdict whatever its id: rows that share an id are judged apart, and a row without id stays only
    where no other of its group stays. Of repeated rows one stays; they are reduced to one row before
    verdicts and ids are brought together.
    """
    make_importable(spark)
    keyed, key = _numbered(docs)
    found = near_duplicates(keyed, id_column=key).groupBy(key).agg(F.min("component_id").alias("component_id"))
    ids = keyed.groupBy(key).agg(F.min("doc_id").alias("_doc"))
    order = F.struct(F.col("_doc").isNull(), "_doc", key)
    stays = found.join(ids, key).groupBy("component_id").agg(F.min_by(key, order).alias(key)).select(key)
    return keyed.join(stays, key, "left_semi").dropDuplicates([key]).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark passage go (operator 7)."""
    make_importable(spark)
    keyed, key = _keyed(docs, "text")
    overlaps = benchmark_overlaps(keyed, _table(spark, sf_dir, "benchmark"), id_column=key)
    return keyed.join(overlaps.select(key).distinct(), key, "left_anti").select(*docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left (operator 2)."""
    make_importable(spark)
    return encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality),
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

# Robust estimates, fitted models and components of links have no SQL form; the stages are tested
# against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
