"""A training-corpus pipeline over ``documents``: toxic texts go, texts in no
known language go, one of each group of near copies stays, secrets are covered,
and what is left is packed into sequences.

Each stage takes (spark, docs, sf_dir) and works on all rows of docs; all but
the last return the columns of docs. Defined results for nulls, empty and
repeated texts are those of the operator that the stage calls.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from flowcubes.llm import language_id, near_dedup, packing, secret_scan, toxicity
from flowcubes.llm.common import prepare, table
from flowcubes.session import ensure_checkpoint_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text scores below the operator's threshold; learned from the
    labels of these documents."""
    prepare(spark)
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text is in one of the languages of these documents."""
    prepare(spark)
    return language_id.keep_known(docs, language_id.learn(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates."""
    prepare(spark)
    return near_dedup.keep_one(docs)


def cover_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with the secrets in their texts covered by marks."""
    prepare(spark)
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens."""
    prepare(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", drop_unknown_language),
    ("near_dedup", drop_near_copies),
    ("secret_scan", cover_secrets),
    ("packing", pack),
]

#: SQL expresses neither the learned stages nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written to the shared folder and
    read again by the next."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
