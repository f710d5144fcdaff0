"""A training corpus from raw documents, in five stages, each on all that the one before kept."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import decontaminate, mixing, near_dedup, quality_gam, token_shards
from ledgerloom.llm.common import small_batches
from ledgerloom.llm.registry import QUERIES, table
from ledgerloom.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality_gam.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (shingles of five words, similarity of 0.8 or more)."""
    return near_dedup.drop_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages: these are cut out, and mostly marked documents go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources in their target weights, as whole documents or, where a pass takes parts, the longest runs of their words."""
    return mixing.mixed_documents(docs, block_words=256)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids written as wavelet-matrix shards, and each row's place in them, as read back."""
    return token_shards.encode_documents(docs)


def _in_small_batches(stage: Stage) -> Stage:
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", _in_small_batches(quality)),
    ("near-duplicates", _in_small_batches(near_duplicates)),
    ("benchmark decontamination", _in_small_batches(decontamination)),
    ("mix of sources", _in_small_batches(mix)),
    ("token shards", _in_small_batches(tokens)),
]

#: Trained models, sketches and draws have no form in SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what each returns is written as Parquet in the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


QUERIES["pipeline"] = run
