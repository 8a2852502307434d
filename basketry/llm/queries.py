"""The registered queries of this subpackage, with production parameters, and their DuckDB counterparts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import (
    alignment,
    byte_bpe,
    disclosure,
    importance,
    oracles,
    order_minhash,
    packing,
    quality_rules,
    secret_scan,
    simhash,
    suffix_dedup,
    token_files,
    toxicity,
    url_filter,
)
from basketry.llm.common import table
from basketry.session import scratch_path

RANKS = "byte_bpe_50k.tiktoken"
TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
END_ID = 2


def _tokenizer_json() -> str:
    with open(public_tokenizers.path(TOKENIZER), encoding="utf-8") as file:
        return file.read()


def op1_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = order_minhash.fingerprints(table(spark, sf_dir, "documents"))
    pairs = order_minhash.with_next(marked, "doc_id", "text", "fingerprint")
    size = F.length("text")
    taken = F.floor(size / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), size - taken), F.substring("next_text", F.lit(1), taken))
    both = order_minhash.add_fingerprints(pairs.withColumn("edited", edited), {"edited": "edited_mark"})
    return both.select(
        "doc_id",
        size.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        order_minhash.as_text(F.col("fingerprint")).alias("fingerprint"),
        order_minhash.as_text(F.col("edited_mark")).alias("edited_fingerprint"),
        order_minhash.likeness(F.col("fingerprint"), F.col("edited_mark")).alias("near_edited"),
        order_minhash.likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = byte_bpe.read_model(public_tokenizers.path(RANKS))
    coded = byte_bpe.encode(table(spark, sf_dir, "documents"), model, public_tokenizers.PATTERN)
    return byte_bpe.decode(coded, model).select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = secret_scan.scan(documents, secret_scan.train(documents))
    spans = F.transform("secrets", lambda s: F.concat_ws("+", s["at"].cast("string"), F.length(s["secret"]).cast("string")))
    return found.select(
        "doc_id",
        "n_candidates",
        F.size("secrets").cast("long").alias("n_secrets"),
        F.array_join(spans, " ").alias("spans"),
        F.sha2("redacted", 256).alias("redacted_sha256"),
    )


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    weights = toxicity.train(documents, table(spark, sf_dir, "labels"))
    return toxicity.score(documents, weights).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, _tokenizer_json(), END_ID)
    return token_files.read_digests(spark, path)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.clean_lines(table(spark, sf_dir, "documents")).drop("clean_text")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("mark")), 16, "0").alias("fingerprint"), "component_id"
    )


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge_urls(pages, url_filter.train(pages)).drop("url")


def op11_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = disclosure.find_private(table(spark, sf_dir, "documents"))
    of_kind = lambda kind: F.filter("spans", lambda s: s["kind"] == kind)
    base = F.filter("spans", lambda s: s["kind"] < len(disclosure.KINDS))
    counts = [F.size(of_kind(i)).cast("long").alias(f"n_{k}") for i, k in enumerate((*disclosure.KINDS, disclosure.TERM))]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(disclosure.written(base), 256).alias("base_sha256"),
        disclosure.written(F.col("spans")).alias("spans"),
    )


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path(PIECES), "rb") as file:
        model = file.read()
    return alignment.digests(table(spark, sf_dir, "documents"), _tokenizer_json(), model)


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {
    "op1_order_minhash": op1_order_minhash,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_secret_scan": op3_secret_scan,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_token_files": op7_token_files,
    "op8_quality_rules": op8_quality_rules,
    "op9_simhash": op9_simhash,
    "op10_url_filter": op10_url_filter,
    "op11_disclosure": op11_disclosure,
    "op12_token_alignment": op12_token_alignment,
    "op13_importance_resampling": op13_importance_resampling,
}

ORACLES = {"op5_suffix_dedup": oracles.repeats(), "op8_quality_rules": oracles.quality()}
