"""A training-data pipeline over ``documents``, stage by stage."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gridtally.llm import langid, neardup, packing, quality, secrets
from gridtally.llm.common import table
from gridtally.llm.queries import PACKING_TOKENIZER, quality_model
from gridtally.operators.staging import checkpoint_folder

#: Documents that share so many per cent of their shingles of five words are near-duplicates.
NEAR_PERCENT = 80

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier finds usable; the poor ones go."""
    return quality.select_quality(docs, quality_model(docs, table(spark, sf_dir, "labels")))


def select_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; those without letters or clear language go.

    If no document has a usable ``lang`` to learn from, all with letters stay.
    """
    return langid.keep_languages(docs, langid.fit(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id.

    Near-duplicates have a Jaccard similarity of 0.8 or more over shingles of five words.
    Of repeated rows one stays; rows without an id stay.
    """
    return neardup.drop_near_duplicates(docs, percent=NEAR_PERCENT)


def scan_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask every secret in the text; no document goes."""
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens."""
    return packing.pack(docs, PACKING_TOKENIZER, public_tokenizers.PATTERN, added=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality", select_quality),
    ("language_id", select_language),
    ("near_dedup", drop_near_copies),
    ("secret_scan", scan_secrets),
    ("packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    folder = f"{checkpoint_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
