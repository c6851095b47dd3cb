"""The dealt operators as queries over the documents and pages tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stockweave.llm import (
    alignment,
    conversation_repair,
    decontaminate,
    html_text,
    language,
    near_dup,
    ngram_lm,
    packing,
    pieces,
    pii,
    quality,
    secrets,
    sharding,
)
from stockweave.llm.common import table


def op1_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digest(table(spark, folder, "documents"))


def op10_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.digest(table(spark, folder, "documents"))


def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.digest(table(spark, folder, "documents"))


def op12_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.digest(table(spark, folder, "documents"))


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_repair.digest(table(spark, folder, "conversations"))


def op2_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.digest(table(spark, folder, "pages"))


def op3_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_dup.duplicates(table(spark, folder, "documents"))


def op4_ngram_scores(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_lm.score(table(spark, folder, "documents"))


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"))


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.digest(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op7_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(table(spark, folder, "documents"))


def op8_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.digest(table(spark, folder, "documents"))


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.digest(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: run for name, run in globals().items() if name.startswith("op")}


def oracle_sql() -> dict[str, str]:
    return {"op9_decontamination": decontaminate.ORACLE_SQL}
