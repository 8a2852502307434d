"""The corpus pipeline: each stage reads what the one before wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from basketry.llm import packing, quality_rules, secret_scan, simhash, suffix_dedup
from basketry.llm.common import table
from basketry.session import stage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Bytes of a passage that stays once: about fifty words of five bytes with the space.
PASSAGE_BYTES = 250


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the line rules keep, without their failing lines."""
    return quality_rules.clean_documents(docs.select(*COLUMNS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    return simhash.drop_near_duplicates(docs.select(*COLUMNS))


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the passages that an earlier document, or place, of the corpus has too."""
    return suffix_dedup.drop_repeats(docs.select(*COLUMNS), length=PASSAGE_BYTES, keep_first=True)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With secrets masked."""
    return secret_scan.redact(docs.select(*COLUMNS), secret_scan.train(docs))


def best_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_duplicates),
    ("suffix_dedup", repeats),
    ("secret_scan", secrets),
    ("best_fit_packing", best_fit),
]

#: Fingerprints, suffix comparison, forests and packing are beyond SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
