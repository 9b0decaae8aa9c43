"""A corpus pipeline of five stages, each a step over all documents the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.llm import exact_dedup, language, mixing, packing, simhash
from statloom.llm.common import free_names, keep_rows, read, store


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a language: null texts and texts without any letter.

    The model learns from the labelled documents handed in, by the rule of the operator.
    """
    model = language.fit(docs.filter(~language.held_out()))
    name, = free_names(docs, "_found")
    found = docs.withColumn(name, language.predictor(model)(F.col("text")))
    return found.filter(F.col(name)["lang"] != language.UNKNOWN).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for runs of white space the smallest doc_id stays."""
    return keep_rows(docs, exact_dedup.exact_dedup(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of linked fingerprints stays, the one with the smallest doc_id."""
    return keep_rows(docs, simhash.near_dedup(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; sources below their target repeat."""
    return mixing.take(docs, mixing.mix_sources(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixed documents in bins; copies of a text never share a bin."""
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("source_mixing", mix),
    ("best_fit_packing", pack),
]

# Fingerprints and suffix automata have no SQL equivalent.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; every result is written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name)
    return docs
