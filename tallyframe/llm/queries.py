"""The operators as named queries over the stored tables, with SQL where SQL can state the rows."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

import tallyframe
from tallyframe.llm import ann, audit, decontaminate, langid, linededup, lm, mixing, pii, quality, shinglejoin, tokenids, topk, turns
from tallyframe.session import fresh_path


def _let_workers_import(spark: SparkSession) -> None:
    """Python workers of a local session find this package wherever the driver was started."""
    root = str(Path(tallyframe.__file__).resolve().parent.parent)
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = f"{root}{os.pathsep}{known}".rstrip(os.pathsep)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    _let_workers_import(spark)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def tokenizer_file() -> str:
    """The public byte-level tokenizer with 50,257 ids."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def _documents(build: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: build(table(spark, folder, "documents"))


def _decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination_query(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def _token_ids(spark: SparkSession, folder: str) -> DataFrame:
    return tokenids.ids_query(table(spark, folder, "documents"), fresh_path(spark, "token-ids"), tokenizer_file())


def _neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return ann.nearest_query(table(spark, folder, "embeddings"))


def _audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit.audit_query(table(spark, folder, "documents"), table(spark, folder, "labels"))


def _repair(spark: SparkSession, folder: str) -> DataFrame:
    return turns.repair_query(table(spark, folder, "conversations"))


def _products(spark: SparkSession, folder: str) -> DataFrame:
    return topk.products_query(table(spark, folder, "embeddings"))


def _quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_query(table(spark, folder, "documents"), table(spark, folder, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": _decontamination,
    "op2_line_dedup": _documents(linededup.lines_query),
    "op3_token_ids": _token_ids,
    "op4_pii": _documents(pii.pii_query),
    "op5_lm_scoring": _documents(lm.lm_query),
    "op6_jaccard_join": _documents(shinglejoin.components_query),
    "op7_nearest": _neighbours,
    "op8_language_id": _documents(langid.language_query),
    "op9_mixing": _documents(mixing.mixing_query),
    "op10_quality": _quality,
    "op11_turn_repair": _repair,
    "op12_filter_audit": _audit,
    "op13_top_products": _products,
}

SQL: dict[str, str] = {
    "op1_decontamination": decontaminate.CONTAMINATION_SQL,
    "op2_line_dedup": linededup.LINES_SQL,
    "op9_mixing": mixing.MIXING_SQL,
    "op12_filter_audit": audit.AUDIT_SQL,
    "op13_top_products": topk.PRODUCTS_SQL,
}
