"""The cleaning pipeline: five stages, each one of the operators, from raw documents to token ids."""

from __future__ import annotations

from functools import reduce

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import decontamination, near_duplicates, pieces, pseudonyms, quality
from ledgerloom.llm.queries import PII_KEY, table
from ledgerloom.session import work_dir


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_duplicates.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms for personal values."""
    return pseudonyms.pseudonymize(docs, PII_KEY)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text of each document."""
    return pieces.encode_digests(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("sentencepiece", encoding_stage),
]

# Language models, sketches and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again for the next."""
    def stored(docs: DataFrame, stage) -> DataFrame:
        path = work_dir(spark, f"pipeline-{stage[0]}")
        stage[1](spark, docs, sf_dir).write.parquet(path)
        return spark.read.parquet(path)

    return reduce(stored, STAGES, table(spark, sf_dir, "documents"))
