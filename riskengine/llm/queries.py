"""One query per operator, with production parameters, over its whole table."""

from __future__ import annotations

import zlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bloomlm, decontam, langid, licenses, mixing, negatives, search, simhash, spelling, substrings, tokens, toxicity,
               warc)
from .common import table


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash of 4-word shingles; links at 4 or fewer bits; smallest doc_id of each component."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices in every text."""
    return licenses.summary(licenses.scan(table(spark, sf_dir, "documents"), licenses.templates()))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text, learned from three of four folds of the documents."""
    docs = table(spark, sf_dir, "documents")
    fold = langid.fold("doc_id", 4)
    got = langid.identify(docs, langid.learn(docs.where(fold != 2)))
    return got.select("doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"),
                      F.col("language.lang").alias("lang_pred"), "language.score", "language.ambiguous")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text, learned from labelled rows of two of three folds."""
    docs, fold = table(spark, sf_dir, "documents"), langid.fold("doc_id", 3)
    fitted = toxicity.learn(docs.where(fold != 1), table(spark, sf_dir, "labels"))
    return toxicity.score(docs, *fitted, into="score").select(
        "doc_id", F.coalesce(fold == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= toxicity.CUT).cast("int").alias("predicted"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words covered by 50-word windows that also start in a document with a smaller id."""
    return substrings.remove_repeats(table(spark, sf_dir, "documents"), length=50)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to weights 1, 2, 3, ... of their sources, three copies at most."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records, repeats as revisits, and read back."""
    return warc.round_trip(table(spark, sf_dir, "pages"), min_bytes=0).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probabilities of all texts, learned from six of seven folds of the documents."""
    return bloomlm.score(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents inside 10-word windows of benchmark items."""
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), length=10)


def op10_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best documents by BM25 for the whole text of each document whose id 50 divides."""
    return search.top_k(table(spark, sf_dir, "documents"), F.col("doc_id") % 50 == 0, k=10)


class LostLetter:
    """Deletes a code point of every 31st run of a document, told by a hash of id and run."""

    @staticmethod
    def start(doc_id: str | None) -> int:
        return zlib.crc32(f"{doc_id or ''}:".encode())

    def __call__(self, start: int, run: str) -> str:
        h = zlib.crc32(run.encode(), start)
        if h % 31:
            return run
        at = h % len(run)
        return run[:at] + run[at + 1:]


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of 7 letters or more that occur twice, their near words and the forms that they vary."""
    return spelling.variants(table(spark, sf_dir, "documents"), LostLetter(), shortest=7, least=2, factor=10)


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every text by the public word tokenizer."""
    counts = tokens.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 2048)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hard negatives for each of five positives of every vector whose id 50 divides."""
    rows, vec_id, label = table(spark, sf_dir, "embeddings"), F.col("vec_id"), F.col("label")
    rows = rows.withColumn("label", F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label))
    return negatives.hard_negatives(rows, vec_id % 50 == 0, n_positives=5, n_negatives=3, low=50, high=95, scale=256)


QUERIES = {f.__name__: f for f in (op1_simhash_near_dedup, op2_license_scan, op3_language_id, op4_toxicity,
                                      op5_substring_dedup, op6_mixing, op7_warc, op8_lm_scoring,
                                      op9_decontamination, op10_topk_search, op11_spelling_variants, op12_token_counts,
                                      op13_hard_negatives)}
