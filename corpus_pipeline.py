"""Corpus pipeline: stages over ``documents``, each written as Parquet and reread as the next one's input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from taxaloom.llm import chosen_path, lines, mixing, queries as Q, toxicity as tox, viterbi
from taxaloom.llm.common import table
from taxaloom.session import freeze


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine scores 0.3 or more go; the others stay as they are."""
    Q.small_batches(spark)
    return tox.without_toxic(docs, tox.train(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on more than a twentieth of their source's documents go; every document stays."""
    Q.small_batches(spark)
    return lines.line_dedup(docs).withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8 or more stays."""
    Q.small_batches(spark)
    return chosen_path.without_near_duplicates(docs, words=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources weigh 3, 1, 2 in turn and share 150 % of all words; documents repeat up to twice."""
    Q.small_batches(spark)
    return mixing.mixed_documents(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document that is left, and whether decoding gives its text back."""
    Q.small_batches(spark)
    return viterbi.encode(docs, Q.piece_model())


STAGES: list[tuple[str, Callable]] = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("sentencepiece", sentencepiece),
]

#: SQL can express neither the fitted models nor the sampling.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = freeze(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
