"""From raw documents to shards: quality, near-duplicates, benchmark leaks, source weights, shards.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that the stage before it kept; all but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.decontamination import without_leaks
from tidemark.llm.divergence import kept_documents
from tidemark.llm.mixing import MixRules, mix_documents
from tidemark.llm.sharding import shard_documents
from tidemark.llm.simhash import simhash_dedup
from tidemark.llm.work import written

SHARDS = 40


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go, each judged by its own text and language, whatever its id. Null and empty texts have no
    words and go; repeated rows go or stay together; an empty table stays empty."""
    return kept_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that of the smallest id; rows with null ids and rows that share
    an id are told apart by their texts. Texts without words, null among them, are one group; an empty table stays
    empty."""
    return simhash_dedup(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain an item of the benchmark go, each searched by its own text, whatever its id. Null texts
    stay; without items all stay; an empty table stays empty."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Small sources are repeated up to the target weights; every document with words is taken at least once. A null
    source is one source; null texts have no tokens; an empty table stays empty."""
    return mix_documents(docs, MixRules(budget=None))


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of each row; equal texts share a shard, null and empty ones among them. An empty table gives
    an empty result."""
    return shard_documents(docs, SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: SQL cannot express the SimHash and CGK stages; tests/llm holds run() against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
