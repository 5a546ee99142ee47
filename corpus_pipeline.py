"""Corpus pipeline: language ID, exact dedup, near-duplicate dedup, PII masking, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and reread as the next stage's ``docs``.  All stages but the
last return the columns of ``docs``, whatever they are; the last returns one row per
packed piece.

Defined cases: null and blank texts (and texts without a letter) go in the first
stage; of rows with equal texts one stays, whatever their ids; a null
``doc_id`` is an id like any other, ordered last; extra columns are carried
through; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dimwright.llm.common import documents, stored
from dimwright.llm.exact_dedup import drop_exact_duplicates
from dimwright.llm.language_id import keep_known_language
from dimwright.llm.minhash_dedup import drop_near_duplicates
from dimwright.llm.packing import pack_documents
from dimwright.llm.pii import mask
from dimwright.llm.queries import BYTE_BPE

#: Below this posterior probability of its best language a document is rejected.
MIN_LANGUAGE_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known with enough certainty."""
    return keep_known_language(docs, MIN_LANGUAGE_SCORE)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id."""
    return drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component."""
    return drop_near_duplicates(docs)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    return mask(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces packed into sequences."""
    return pack_documents(docs, BYTE_BPE)


STAGES = [("language", language), ("exact", exact), ("near", near), ("private", private), ("packed", packed)]

#: Language scores, similarity components and byte-pair tokens cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
