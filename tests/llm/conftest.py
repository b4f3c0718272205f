"""Small documents that hold the cases every operator must treat."""

import pytest
from pyspark.sql import functions as F

LONG = "long text " + " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
DOCS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "src0"),
    (2, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "src0"),
    (3, None, "de", "src1"),
    (4, "", None, None),
    (5, " \n\t ", "fr", "nowhere"),
    (6, LONG, "en", "src3"),
    (7, "über straße 漢字 😀 <|endoftext|> it's we'll\n\nlast line", "xx", "src4"),
    (8, "one", "es", "src11"),
    (8, "one", "es", "src11"),
    (None, "a document without an id but with some words in it", "en", "src2"),
    (None, None, None, None),
    (9, "a\rb\x0bc\x0cd\x00e", "en", "src2"),
]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string, lang string, source string") \
        .withColumn("n_chars", F.length("text").cast("long"))


@pytest.fixture
def clashing(docs):
    """The same documents with columns named like those that the operators make."""
    names = ["id", "row", "key", "fp", "fingerprint", "component", "component_id", "kept", "n_words", "n_tokens", "leaf",
             "epoch", "bucket", "batch", "place", "cell", "n", "grid", "deleted", "partners", "doc", "lines", "count",
             "host", "path", "rule", "verdict", "held", "held_out", "score", "word", "gram", "txt", "n_bytes", "over_limit"]
    return docs.withColumns({c: F.lit("mine") for c in names})


@pytest.fixture
def empty(docs):
    return docs.where("false")
