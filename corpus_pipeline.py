"""A corpus pipeline of five stages; each reads the table that the one before it wrote."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import decontaminate, mixing, near_copies, secret_scan, toxicity
from riskloom.llm.common import table
from riskloom.session import remove, shared_folder

#: Documents scored at least this toxic go.
REJECT = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents that the classifier rejects go; it learns from the labelled ones among ``docs``."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity.score(spark, F.col("text"), model) < REJECT)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: one document of each class of near copies stays, that with the smallest id."""
    return near_copies.without_near_copies(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents in which a benchmark passage is found go."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: secrets in the text are replaced by their kind; ``n_chars`` follows the new text."""
    clean = docs.withColumn("text", secret_scan.redacted(F.col("text")))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*[F.col(f"`{c}`") for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: a row for each drawing of a document, half of all tokens by the target weights."""
    return mixing.mixed_sources(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_leaks),
    ("secrets", redact_secrets),
    ("mixing", mix),
]

#: A learned model and sampled hash orders have no SQL; tests compare the first four stages with plain Python, the SQL of op4 states the last.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage is written as Parquet to the shared folder and read again.

    A stage's table goes when the next one is written; the last one's stays, as the result is read from it.
    """
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            remove(spark, f"{folder}/{before}")
        before = name
    return docs
