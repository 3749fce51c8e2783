"""The registered queries of this subpackage: each operator on its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstrata.llm.bpe import encoded_digests
from ledgerstrata.llm.chat import format_preferences, swapped_replies
from ledgerstrata.llm.clustering import cluster_vectors
from ledgerstrata.llm.decontam import benchmark_overlaps
from ledgerstrata.llm.language import fit_language, predict_language
from ledgerstrata.llm.licenses import scan_licenses
from ledgerstrata.llm.near_dup import near_duplicates
from ledgerstrata.llm.quality import quality_verdicts
from ledgerstrata.llm.repair import repair_reports
from ledgerstrata.llm.shipping import make_importable
from ledgerstrata.llm.token_counts import token_counts
from ledgerstrata.llm.topk import exact_top_k
from ledgerstrata.llm.toxicity import fit_toxicity, held_out, score_documents
from ledgerstrata.llm.urls import judge_urls

# The rules of the URL query.
URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    make_importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts(_table(spark, sf_dir, "documents"), path)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return encoded_digests(_table(spark, sf_dir, "documents"), path)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    labels = _table(spark, sf_dir, "labels").where(~held_out(3, 1))
    scored = score_documents(docs, fit_toxicity(docs, labels))
    return scored.select(
        "doc_id",
        held_out(3, 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    predicted = predict_language(docs, fit_language(docs.where(~held_out(4, 2))))
    return predicted.select(
        "doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score", "rejected"
    )


def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(_table(spark, sf_dir, "pages"), URL_RULES)


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = swapped_replies(_table(spark, sf_dir, "conversations"))
    flat = lambda name: F.array_join(
        F.transform(name, lambda s: F.concat_ws("-", s["start"], s["end"])), ","
    ).alias(name)
    return format_preferences(pairs).select(
        "conv_id", "n_common", "prompt", "chosen", "rejected",
        flat("chosen_spans"), flat("rejected_spans"),
    )


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return benchmark_overlaps(docs, benchmark)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(_table(spark, sf_dir, "documents"))


def op9_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), shingle=4, percent=80)


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_table(spark, sf_dir, "documents"))


def op11_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(_table(spark, sf_dir, "embeddings"), k=8, rounds=10, length=64, seed=3)


def damaged_turns(conversations: DataFrame) -> DataFrame:
    """Conversations with planted faults, by a hash of conversation and turn; NULLs become one space.

    Of 20 turns one is dropped (``present`` is false), one emptied, one loses its marks of a sentence's
    end, one comes twice and one gets the role user.
    """
    filled = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn"))) % 20
    text = (
        F.when(F.col("fate") == 1, "")
        .when(F.col("fate") == 2, F.translate(filled("text"), ".!?", ""))
        .otherwise(filled("text"))
    )
    copies = F.when(F.col("fate") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return conversations.withColumn("fate", fate).select(
        "conv_id",
        "turn",
        F.when(F.col("fate") == 4, "user").otherwise(filled("role")).alias("role"),
        text.alias("text"),
        (F.col("fate") != 0).alias("present"),
        F.explode(copies).alias("copy"),
    )


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = damaged_turns(_table(spark, sf_dir, "conversations"))
    return repair_reports(turns, present="present")


def op13_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return exact_top_k(vectors.where("vec_id % 100 = 0"), vectors, k=10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_bpe": op2_bpe,
    "op3_toxicity": op3_toxicity,
    "op4_language": op4_language,
    "op5_urls": op5_urls,
    "op6_chat": op6_chat,
    "op7_decontamination": op7_decontamination,
    "op8_quality": op8_quality,
    "op9_near_dup": op9_near_dup,
    "op10_licenses": op10_licenses,
    "op11_clusters": op11_clusters,
    "op12_repair": op12_repair,
    "op13_top_k": op13_top_k,
}
