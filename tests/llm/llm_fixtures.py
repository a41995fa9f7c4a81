"""Frames that all tests of the training-data operators share."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
LONG = "Some words of a very long text, number " + " ".join(f"{i} and" for i in range(30_000))
TEXTS = [
    (1, "The first text has a few words of its own, and an end."),
    (2, "The first text has a few words of its own, and an end."),
    (2, "The first text has a few words of its own, and an end."),
    (3, None),
    (4, ""),
    (None, "A text without an id is a text like any other one here."),
    (None, None),
    (5, LONG),
    (6, LONG),
    (7, " \n\t "),
    (8, "Ünïcödé ÉÈ ßtraße 日本語 🙂 <|endoftext|> \u0000 end"),
    (9, "x" * 70_000),
]
#: Names of columns that operators add, in other cases too.
CLASHING = ["Score", "kept", "SHARD", "fingerprint", "n_words", "license", "host", "rank", "spans"]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empty and very long texts, repeated rows, and columns named like results."""
    df = spark.createDataFrame(TEXTS, "doc_id long, text string")
    return df.select("*", *(F.lit("mine").alias(c) for c in CLASHING))


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)


@pytest.fixture()
def docs(spark):
    """A frame of texts with ids from 0."""

    def make(*texts):
        return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")

    return make
