"""The corpus pipeline: toxicity, exact dedup, SimHash near-dedup, substring dedup, packing.

Every stage takes (spark, docs, folder) and returns a table, which is written as Parquet and read
again as the next stage's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cadastra.llm import exact, packing, simhash, substrings, toxicity
from cadastra.llm.queries import TOKENIZER, table
from cadastra.session import ensure_checkpoint_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents the classifier does not predict toxic. A text without words stays."""
    return toxicity.keep_clean(docs, toxicity.fit(table(spark, folder, "documents"), table(spark, folder, "labels")))


def drop_exact(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The one row that stays of each group of equal texts."""
    return exact.keep_first(docs)


def drop_near(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates."""
    return simhash.keep_first(docs)


def drop_passages(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, without the passages that a document with a smaller id has too."""
    return substrings.remove(docs)


def pack(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of power-of-two length, each a sequence of its own."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact),
    ("simhash_near_dedup", drop_near),
    ("substring_dedup", drop_passages),
    ("packing", pack),
]

# The classifier, the fingerprints and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
