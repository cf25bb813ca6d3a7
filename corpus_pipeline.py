"""A corpus from raw documents to token ids, one operator a stage.

Each stage takes (spark, docs, sf_dir) and works on all rows of its predecessor's output, which is
written as Parquet and read again.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillwork.llm import langid, mixing, pieces, pii, shinglejoin
from tillwork.llm.common import stored, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter or in no known language go; a missing language is filled in."""
    return langid.with_known_language(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows that the Jaccard join links by their texts, one with the smallest id stays."""
    return shinglejoin.one_of_each(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked in the text."""
    return pii.masked_documents(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids): the texts in pieces of a public vocabulary, with merge-dropout."""
    return pieces.encoded(docs, pieces.public_model())


STAGES = [
    ("language", known_language),
    ("near_copies", without_near_copies),
    ("personal_data", without_personal_data),
    ("mix", mixed_sources),
    ("pieces", token_ids),
]

#: a trained network and keyed permutations are not SQL; tests compare each stage with plain Python
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
