"""Documents to packed training sequences, in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rookery.llm import mixing, packing, quality_rules, simhash, unit_dedup
from rookery.llm.queries import MIX_ENTROPY, MIX_REPEATS, tokenizer_path
from rookery.llm.rows import materialise
from rookery.llm.ship import ship
from rookery.plans.registry import query

ORACLE_SQL = None


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; the model is fitted on labelled rows of ``docs``."""
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_rules.keep_good(docs, quality_rules.fit_quality(docs, labels))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    ship(spark)
    return simhash.drop_near_copies(docs)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with passages that an earlier one has cut out of their texts."""
    ship(spark)
    return unit_dedup.without_repeated_units(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of documents in the mixture of sources: a document is there once per block it is in."""
    return mixing.mixed_documents(docs, entropy=MIX_ENTROPY, repeats=MIX_REPEATS)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences of 4096 tokens."""
    ship(spark)
    return packing.pack(docs, tokenizer_path()).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality_rules", good_documents),
    ("simhash_near_dedup", without_near_copies),
    ("substring_dedup", without_repeated_passages),
    ("mixing_sources", mixed_sources),
    ("best_fit_packing", packed_sequences),
]


@query("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again as the next one's documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
