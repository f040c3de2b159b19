"""The corpus pipeline: five stages from raw documents to token ids.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet
in the session's shared folder and read again as the next stage's documents.

Nulls in any column, empty and very long texts, ties, repeated rows and empty
tables have the results that the operators' modules define; no stage fails on
them. A text without words is no copy of another, holds no benchmark item and
no secret, and has no token. Columns beyond those of documents are handed on by
all stages but the last, whose result has the columns of the encoder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weblattice.llm import bpe, decontaminate, ngram_join, secrets, toxicity
from weblattice.llm.common import table, written
from weblattice.llm.queries import toxic_labels, vocabulary_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below their language's threshold."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, toxic_labels(spark, sf_dir)))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: five words, similarity 0.8."""
    return ngram_join.one_of_each(docs, ngram_join.Measure(words=5, percent=80))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark in the text."""
    return secrets.redacted(docs, secrets.fit(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text."""
    return bpe.digests(docs, vocabulary_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("secrets", hide_secrets),
    ("bpe", encode),
]

#: The stages learn models and encode tokens, which SQL cannot express; they
#: are tested against brute-force versions in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
