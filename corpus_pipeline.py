"""The corpus pipeline: language, exact copies, near copies, source mix, packing.

``STAGES`` lists the stages; each takes (spark, docs, sf_dir) and is written as Parquet before the next reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from retentia import configure
from retentia.llm import exact_dedup, language, mixing, packing, simhash
from retentia.llm.common import documents, stored
from retentia.llm.queries import tokenizer


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows; texts without letters and unclear ones go."""
    return language.keep_identified(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_exact_duplicates(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints."""
    return simhash.drop_near_duplicates(docs, shingle=4, distance=4)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the weight of its source asks for, in random order."""
    return mixing.replicated(docs).select(*[F.col(f"`{c}`") for c in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all sequences."""
    return packing.pack(docs, tokenizer(), capacity=1024)


STAGES = [
    ("language", language_stage),
    ("exact_dedup", exact_stage),
    ("simhash_dedup", near_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# Language, fingerprints and token ids cannot be computed in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(configure(spark), sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
