"""A corpus pipeline of the library's operators; each stage gets what the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regulink.llm import decontamination, languages, near_dedup, packing, personal_data
from regulink.llm.common import table
from regulink.session import freeze


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which some language is told; texts that are null or have no letter go.

    The languages are learned from the labels of the documents given.
    """
    return languages.keep_identified(docs, languages.fit_languages(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies (shingles of five words,
    similarity of 0.8 or more)."""
    return near_dedup.keep_one(docs, words=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``, not even with other numbers, names or units."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in their texts replaced by its kind in brackets."""
    masked = personal_data.mask_documents(docs, personal_data.fit_spans(docs))
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and the training sequences they go to."""
    return packing.pack_documents(docs, public_tokenizers.path(packing.TOKENIZER))


STAGES = [
    ("language", identify_language),
    ("near_dedup", drop_near_copies),
    ("decontaminate", decontaminate),
    ("personal_data", mask_personal_data),
    ("pack", pack),
]

# Language models, span classifiers and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = freeze(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
