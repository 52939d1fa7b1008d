"""A corpus pipeline: filter, deduplicate, balance and pack documents.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is written as
Parquet and read again as the next stage's ``docs``. All but the last return the columns of
documents.
"""

from __future__ import annotations

from functools import partial

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from creditloom.llm import exact_dedup, mixing, near_dup, packing, toxicity
from creditloom.sources.staging import settled


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents judged toxic go."""
    return toxicity.clean_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return exact_dedup.keep_documents(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays."""
    return near_dup.keep_documents(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources meet their target weights by repetitions of whole documents."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each token piece of each document lies in the training sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", not_toxic),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("mixing", mixture),
    ("packing", packed),
]

#: Training and sketches have no SQL form; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; every result but the last is written before the next.

    What a stage writes on its way goes when its result is written. Null texts, identifiers and
    sources, empty and repeated rows, empty tables and extra columns pass through every stage
    as its operator's docstring says; none fails on them.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = settled(spark, f"stage-{name}", partial(step, spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
