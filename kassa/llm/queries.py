"""One query per operator, over its whole table, and DuckDB twins where SQL
can express the result."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (exact_dedup, license_scan, line_dedup, minhash, mixing, packing, periodic_runs, quality, slack_packing, token_alignment,
               topk, toxicity, url_filter)
from .common import keep, table
from .oracle import ORACLE as ORACLE

# The rules of the page filter, host and path.
BLOCK = ["net/", "example.com/de/"]
ALLOW = ["example.net/en/", "org/fr/"]


def bpe_encoder():
    """The byte-level BPE of the installed vocabulary files."""
    import public_tokenizers as vocabularies
    return packing.byte_bpe_encoder(vocabularies.path("byte_bpe_50k.json"), vocabularies.path("byte_bpe_50k.tiktoken"),
                                    vocabularies.PATTERN, ("<|endoftext|>",))


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), bpe_encoder(), with_ids=False)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents")).drop("spans")


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_topk(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = keep(quality.document_statistics(table(spark, sf_dir, "documents")), "statistics")
    return quality.score_statistics(stats, quality.fit(stats, table(spark, sf_dir, "labels")))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents")).drop("n_chunks")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), ALLOW, BLOCK).select(
        "page_id", "host", "path", "rule", "verdict")


def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), k=3, numerator=85, denominator=100)


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents")).drop("shard", "quota")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "text", F.size("removed_spans").cast("long").alias("n_runs"),
        F.aggregate("removed_spans", F.lit(0).cast("long"), lambda a, s: a + s["words"]).alias("n_words_removed"))


def op11_min_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slack_packing.pack(table(spark, sf_dir, "documents"), bpe_encoder(), with_ids=False)


def planted(doc_id: str | None, words: list[bytes]) -> list[bytes]:
    """The words of the documents whose id's checksum ends in 0, made
    periodic from some word on."""
    h = zlib.crc32((doc_id or "").encode())
    if doc_id is None or h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * ((n - a) // p + 1))[:n - a]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), edit=planted)
    best = F.col("best")
    return found.withColumn("best", periodic_runs.strongest(F.col("runs"))).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *[best[c].alias(c) for c in ("start", "length", "period")],
        F.floor(F.lit(1000) * best["length"] / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(periodic_runs.listed(F.col("runs")), 256).alias("runs_sha256"), F.sha2("kept_text", 256).alias("collapsed_sha256"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as vocabularies
    documents, _ = token_alignment.align_corpus(
        table(spark, sf_dir, "documents"), token_alignment.byte_bpe(vocabularies.path("byte_bpe_50k.tiktoken"), vocabularies.PATTERN),
        token_alignment.sentence_pieces(vocabularies.path("piece_bpe_32k.model")))
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2("groups", 256))
    return documents.withColumn("groups_sha256", digest).drop("groups")


QUERIES = {f.__name__: f for f in (
    op1_best_fit_packing, op2_license_scan, op3_exact_topk, op4_quality_classifier, op5_exact_dedup,
    op6_url_filter, op7_toxicity, op8_minhash_dedup, op9_source_mixing, op10_line_dedup,
    op11_min_slack_packing, op12_periodic_runs, op13_token_alignment)}
