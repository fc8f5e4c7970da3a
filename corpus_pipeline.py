"""A training-data pipeline over ``documents``, in five stages.

Each stage works on what its predecessor kept, written as Parquet and read
again.  All but the last return the columns of ``documents``.

All stages have these cases in common.  Nulls: a null text is an empty one, other
null columns stay as they are, and a row without doc_id is a document of its own.
Very long texts are read whole.  Repeated rows are judged alike, each on its own but
for near-duplicates.  An empty table stays empty.  Further columns, whatever their
names, are kept by all stages but the last.  What else a stage does with them, and
with ties, its own text says.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from duetto.llm import language, neardup, packing, secrets, toxicity
from duetto.llm.common import ensure_checkpoint_dir, table

#: Documents that share so much of their shingles' union are near-duplicates here.
NEAR_PERCENT = 80


def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity: documents with a score of 0.5 or more go.

    Null and empty texts have no sentence and stay; without labels of both kinds
    nobody goes.  Repeated rows stay or go together.
    """
    return toxicity.keep_civil(docs, table(spark, sf_dir, "labels"))


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language: documents whose language can't be told go.

    So do null and empty texts and those without a letter; where no row has a usable
    label, all go.  Of languages that fit equally well, the first by name counts.
    """
    return language.keep_identified(docs)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near-duplicates: the smallest doc_id of each group stays.

    Null, empty and blank texts are like nothing else and stay; so do rows without
    doc_id.  Of rows that repeat id and text one stays; different texts of one doc_id are
    one document and stay or go together.
    """
    return neardup.keep_one_of_each(docs, NEAR_PERCENT)


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets: every span is replaced by a mark; all documents stay.

    A null text stays null; spans that overlap are one mark.
    """
    return secrets.redact_secrets(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: every document's place in training sequences.

    Null and empty texts are a piece of length 0 in some bin; repeated rows have places
    of their own.  Only the columns of the packing are returned.
    """
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", civil),
    ("language", identified),
    ("near_dedup", deduplicated),
    ("secrets", redacted),
    ("packing", packed),
]

#: Fitted models and minima are beyond SQL; the stages are tested against
#: brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; the tables between them are in the shared
    checkpoint folder."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
