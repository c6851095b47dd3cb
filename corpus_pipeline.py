"""From raw documents to packed training sequences.

Every stage works on what the one before kept, written as Parquet to the shared folder and read
again. All stages but the last return the columns of the documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave.llm import decontaminate, near_dup, packing, pii, quality
from stockweave.llm.common import table
from stockweave.session import scratch_path, scratch_scope


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the counts and the likelihood ratio, learnt from ``labels``."""
    return quality.filter_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    return near_dup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat too little of ``benchmark`` to be contaminated."""
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in the text replaced by its kind."""
    clean = pii.redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast("bigint"), F.col("n_chars")))


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in the training sequences."""
    return packing.pack_documents(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("sequence_packing", sequence_packing),
]

# Tokens and packing cannot be expressed in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed sequences of the ``documents`` table. Runs all stages but the last at once.

    What a stage stored for itself is deleted when its rows are written.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        with scratch_scope(spark):
            rows = stage(spark, docs, sf_dir)
            rows.write.parquet(path)
        docs = spark.read.schema(rows.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


def write(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The rows of :func:`run` as Parquet at ``path``; all stored between is deleted."""
    with scratch_scope(spark):
        run(spark, sf_dir).write.parquet(path)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
