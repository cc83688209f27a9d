"""From raw documents to packed training sequences, in stages.

Each stage works on the documents that its predecessor kept, and takes (spark, docs, folder). All but
the last return the columns of `documents`. A stage's result is written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from matchloom.llm import near_copies, packing, pii, quality_rules, toxicity
from matchloom.llm.common import table
from matchloom.session import store


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that pass the fixed rules and are no outliers for their language and source."""
    return quality_rules.keep_good(docs)


def clean_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the classifier, trained on confirmed examples, doesn't call toxic."""
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, folder, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 of their sets of five-word shingles."""
    return near_copies.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return pii.redact_documents(docs, pii.train(docs))


def pack(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The pieces of all documents and their places in training sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality", quality),
    ("toxicity", clean_language),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("packing", pack),
]

#: Several stages learn from the documents, which SQL cannot express; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages applied to the documents in a folder."""
    docs = table(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, folder), f"stage-{name}")
    return STAGES[-1][1](spark, docs, folder)
