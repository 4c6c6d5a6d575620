"""The corpus pipeline: five operators in a row, each over all that the one before kept.

Every stage takes nulls in any column, empty and very long texts, repeated rows, null and repeated
ids and empty tables; other columns than those of documents are not read, whatever their names.
All but the last return the columns of documents, and an empty table for an empty one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tablewinnow.llm import language, mixing, near_dedup, packing, pii
from tablewinnow.llm.common import ensure_checkpoint_dir, read

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as those of a learned language do stay; others and undetermined
    ones go: null and empty texts, and texts without a letter. Rows with a null id or language stay
    by their text, and equal texts stay or go together."""
    docs = docs.select(*COLUMNS)
    return language.keep_known(docs, language.fit_to_keep(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one of least id, and of rows that share
    it one. Null ids are greater than any; null, empty and blank texts are one group."""
    return near_dedup.one_of_each(docs.select(*COLUMNS))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; personal data in them is masked. Null texts stay null, and texts without any
    stay as they are, with their n_chars."""
    docs = docs.select(*COLUMNS)
    return pii.masked(docs, pii.fit(docs))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once, or a few times. Null sources are
    one source; texts without words take nothing from a target."""
    docs = docs.select(*COLUMNS)
    return mixing.repeated(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of fixed length. Null and empty texts are their end token."""
    return packing.pack(docs.select("doc_id", "text"), packing.vocabulary_paths())


STAGES = [
    ("language ID", language_id),
    ("SimHash near-dedup", near_duplicates),
    ("PII", personal_data),
    ("mixing sources", source_mix),
    ("packing", packed),
]

# Neither fingerprints nor trained models can be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces that all stages make of the documents table; between stages the documents
    are written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        result = stage(spark, docs, sf_dir)
        if number + 1 == len(STAGES):
            return result
        result.write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return docs
