"""Language identification on held-out rows, and its parts."""

import math

import numpy as np
from pyspark.sql import functions as F

from ledgerstrata.llm.language import (
    LanguageModel,
    _clusters,
    _unit,
    fit_language,
    gram_counts,
    predict_language,
)
from ledgerstrata.llm.queries import QUERIES


def test_gram_counts_see_every_gram_and_ignore_what_is_no_letter():
    assert gram_counts("ab").sum() == 4 + 3 + 2
    assert (gram_counts("Ab 12 - cd") == gram_counts("ab cd")).all()
    assert gram_counts("").sum() > 0


def test_clusters_find_separate_groups():
    rng = np.random.default_rng(5)
    groups = np.eye(6)[:3]
    rows = _unit(np.concatenate([g + rng.normal(0, 0.02, (30, 6)) for g in groups]))
    centroids = _clusters(rows, 3)
    assert np.allclose(sorted((centroids @ groups.T).max(axis=0)), 1, atol=0.01)


def test_held_out_accuracy(spark):
    directory = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{directory}/documents.parquet")
    got = QUERIES["op4_language"](spark, directory).join(docs, "doc_id").where("held_out")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97


def test_odd_documents(spark, odd_docs):
    learned = spark.createDataFrame(
        [(i, "the house and the tree", "en") for i in range(20)]
        + [(i, "das haus und der baum", "de") for i in range(20, 40)]
        + [(41, None, "fr"), (42, "12 34", "fr"), (None, "le", "fr"), (43, "la", None)],
        "doc_id long, text string, lang string",
    )
    model = fit_language(learned)
    assert set(model.languages) == {"en", "de"}
    got = predict_language(odd_docs, model).collect()
    assert len(got) == odd_docs.count()
    assert [r.lang_pred for r in got[:3]] == ["und"] * 3
    assert all(r.lang_pred in ("en", "de") and 0 <= r.score <= 1 for r in got[3:])
    assert got[5].rejected and not got[0].rejected
    assert predict_language(odd_docs.limit(0), model).count() == 0
    nothing = fit_language(learned.limit(0))
    assert {r.lang_pred for r in predict_language(odd_docs, nothing).collect()} == {"und"}


def plain_vector(text, idf):
    """Normalised TF-IDF of hashed n-grams as a dictionary, one n-gram at a time."""
    data = f" {text.lower()} ".encode()
    kept = [c if 97 <= c <= 122 or c > 127 else 32 for c in data]
    kept = [c for i, c in enumerate(kept) if i == 0 or c != 32 or kept[i - 1] != 32]
    counts = {}
    for n, mark in ((1, 0), (2, 1 << 25), (3, 1 << 26)):
        for i in range(len(kept) - n + 1):
            gram = int.from_bytes(bytes(kept[i : i + n]), "big") + mark
            bucket = (gram * 0x9E3779B1 % 2**32) >> 20
            counts[bucket] = counts.get(bucket, 0) + 1
    vector = {k: math.log1p(n) * idf[k] for k, n in counts.items()}
    length = math.sqrt(sum(v * v for v in vector.values()))
    return {k: v / length for k, v in vector.items()}


def test_predictions_equal_plain_cosines():
    rng = np.random.default_rng(6)
    idf = rng.uniform(1, 4, 4096).astype(np.float32)
    centroids = _unit(rng.uniform(0, 1, (6, 4096)) ** 8).astype(np.float32)
    names = ["a", "a", "b", "b", "c", "c"]
    texts = ["the house, and the tree", "ÄÖ über 12 Straße", "x", "  a  b--c  " * 40, "λόγος καὶ ἔργον"]
    vectors = [plain_vector(t, idf) for t in texts]
    cosines = [[sum(v * c[k] for k, v in x.items()) for c in centroids.astype(float)] for x in vectors]
    reach = np.array([max(row[i] for row in cosines) - 1e-3 for i in range(6)])
    got = LanguageModel(idf, centroids, names, reach).predict(texts)
    for row, (name, score, rejected) in zip(cosines, got):
        best = int(np.argmax(row))
        assert name == names[best] and abs(score - row[best]) < 1e-5 and rejected == (row[best] < reach[best])
