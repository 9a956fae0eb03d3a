"""Training-data pipeline: five stages over ``documents``, each one of the operators.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and read
again as the next one's docs. All but the last return the columns of documents.

1 quality   documents that the attention-based classifier scores below 0.7 go
2 simhash   one document of each near-duplicate component stays (smallest doc_id)
3 pii       personal data are replaced by their kind in brackets
4 mixing    documents stay as often as the mix to target weights takes them; the
            document at a source's cut ends there
5 packing   one row for each piece: its sequence, offset, length and checksum

Where a stage changes a text, ``n_chars`` is counted anew. Null texts and ids,
empty tables and further columns pass through as the operators' docstrings say.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerscope.llm import mixing, packing, pii, quality_classifier, simhash
from ledgerscope.session import ensure_checkpoint_dir


def _recounted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_classifier.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _recounted(pii.redacted(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _recounted(mixing.mixed_documents(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("simhash", near_duplicates),
    ("pii", personal_data),
    ("mixing", mix),
    ("packing", pack),
]

#: SQL can't express the fitted and hashed stages; tests/llm holds them against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
