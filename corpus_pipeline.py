"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; its result
is written as Parquet and read again as the next one's ``docs``.  All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskengine.llm import decontam, langid, mixing, simhash, substrings
from riskengine.llm.common import Scratch, table


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those of no letter or of two near languages go."""
    rows = docs.select(F.struct("*").alias("d"), F.col("text"))  # a struct can't clash with the prediction's name
    got = langid.identify(rows, langid.learn(docs))
    return got.where((F.col("language.lang") != langid.UNKNOWN) & ~F.col("language.ambiguous")).select("d.*")


def near_deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id."""
    return simhash.keep_one(docs, shingle=4, max_bits=4)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts less the words of 50-word windows that start in an earlier document too."""
    cleaned = substrings.cleaned_texts(docs, length=50)
    if "n_chars" not in docs.columns:
        return cleaned
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a 10-word window of a benchmark item."""
    return decontam.without_contaminated(docs, table(spark, sf_dir, "benchmark"), length=10)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often each document is taken for the sources' target weights."""
    return mixing.mix(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identified),
    ("simhash_near_dedup", near_deduplicated),
    ("substring_dedup", without_repeats),
    ("decontamination", decontaminated),
    ("mixing", mixed),
]

#: SimHash fingerprints are not expressible in SQL; the tests hold the pipeline against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over the ``documents`` of ``sf_dir``."""
    scratch, docs = Scratch(spark, "pipeline"), table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir))
    return docs
