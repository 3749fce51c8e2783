import random

import pytest
from pyspark.sql import functions as F

from ledgerstrata.llm.shipping import make_importable

LONG = "word " * 30_000


@pytest.fixture(scope="session", autouse=True)
def importable(spark):
    make_importable(spark)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """NULLs in each column, empty, blank and very long texts, repeated rows, clashing extra columns."""
    rows = [
        (1, None, "en", "s"),
        (2, "", None, "s"),
        (3, " \n\t ", "en", None),
        (None, "alpha beta gamma delta epsilon", "en", "s"),
        (5, LONG, "en", "s"),
        (6, "x" * 50_000, "de", "s"),
        (7, "alpha beta gamma delta epsilon", "en", "s"),
        (7, "alpha beta gamma delta epsilon", "en", "s"),
        (8, "İstanbul ½ \x00   <|endoftext|> ΑΣ ::", None, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for name in ("_id", "_text", "_key", "n_words", "score", "component", "ids"):
        docs = docs.withColumn(name, F.lit("extra"))
    return docs


@pytest.fixture(scope="session")
def vocabulary():
    rng = random.Random(7)
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(500)]
