"""A corpus from documents: identify languages, drop near copies and benchmark text, mix sources, pack ids.

Each stage is a function of (spark, docs, sf_dir), where ``docs`` is what the stage before
kept, stored as Parquet. All but the last return the columns of documents; the last returns per
document of the corpus its id, where its ids begin, how many they are and their checksum. The
mix takes some documents twice, and these stand twice in the packed corpus.

Learned and counted things (languages, frequent shingles, source sizes) come from the stage's own input.
Documents without id pass the near-copy stage, and stand first in the packed corpus.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyframe.llm import decontaminate, langid, mixing, shinglejoin, tokenids
from tallyframe.llm.queries import table, tokenizer_file
from tallyframe.session import fresh_path, staged


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shinglejoin.one_per_component(docs, stored=True)


def drop_benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), stored=True)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.take_mix(docs)


def pack_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tokenids.ids_query(docs, fresh_path(spark, "corpus-ids"), tokenizer_file())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_benchmark_text),
    ("mixing", mix_sources),
    ("token_ids", pack_ids),
]

#: Language identification and tokenizing can't be stated in SQL; the tests have brute-force versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what a stage returns is stored before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs, f"pipeline-{name}")
    return docs
