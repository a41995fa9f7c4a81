"""The training-data pipeline: stages over the documents, each written as Parquet and read again.

A stage takes (spark, docs, sf_dir) and works on all that the one before it kept. All but the
last return the columns of ``docs``; further columns come along unchanged, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import decontamination, packing, quality, simhash, suffix_dedup
from corpusloom.llm.queries import VOCABULARY, table
from corpusloom.session import fresh_path

#: Words of a shingle, and bits that the fingerprints of near copies differ in at most.
SHINGLE, THRESHOLD = 4, 4
#: Passages of over 50 words are cut where they also stand elsewhere.
PASSAGE_WORDS = 51

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _aside(docs: DataFrame) -> DataFrame:
    """``docs`` with other names for all columns but the id and the text, so that none clashes."""
    return docs.select(
        *(F.col(f"`{c}`").alias(c if c in ("doc_id", "text") else f"_in{i}") for i, c in enumerate(docs.columns))
    )


def _back(result: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` under their own names."""
    return result.select(
        *(F.col(c if c in ("doc_id", "text") else f"_in{i}").alias(c) for i, c in enumerate(docs.columns))
    )


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it is trained on the labelled ones among ``docs``."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return _back(quality.classify(_aside(docs), model).filter("predicted = 1"), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints are linked: one of the least id."""
    found = simhash.near_duplicates(_aside(docs), shingle=SHINGLE, threshold=THRESHOLD, keep_text=True)
    return _back(found.filter("stays"), docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of over 50 words that also stand elsewhere; n_chars follows the text."""
    cut = suffix_dedup.remove_repeats(_aside(docs), words=PASSAGE_WORDS).withColumn("text", F.when(F.col("text").isNotNull(), F.col("kept_text")))
    out = _back(cut, docs)
    if "n_chars" not in docs.columns:
        return out
    kind = docs.schema["n_chars"].dataType
    return out.withColumn("n_chars", F.coalesce(F.char_length("text").cast(kind), F.col("n_chars")))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    found = decontamination.decontaminate(_aside(docs), table(spark, sf_dir, "benchmark"))
    return _back(found.filter("not contaminated"), docs)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences, with their token ids."""
    return packing.pack(docs, VOCABULARY)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", keep_quality),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeats),
    ("benchmark_decontamination", drop_contaminated),
    ("packing", pack_documents),
]

#: SQL can express neither the classifier nor the tokens; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What all stages make of the documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
