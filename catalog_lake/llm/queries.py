"""The registered queries of the training-data operators: one thin query per operator."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog_lake.llm import (
    alignment, decontaminate, html_extract, line_dedup, packing, periodic_runs, pii, quality, simhash, substring_dedup, suffix_dedup,
    token_counts, toxicity)
from catalog_lake.llm.common import table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that stand on many sites."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return line_dedup.remove_boilerplate(docs).select("row.doc_id", "n_lines", "n_removed", F.col("clean").alias("text"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of the threshold table for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.apply_rules(docs).select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                            "n_repeat_words", "base_failed", "kept")


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 50-byte strings that also start in a document with a smaller id."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs, length=50).withColumnRenamed("doc", "doc_id")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probabilities of low quality and, given that, of toxicity for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")
    chain, _ = toxicity.fit_chain(docs, labels, ("low_quality", "toxic"))
    return toxicity.predict_chain(docs, chain).select("doc_id", "p_low_quality", "p_toxic", chain.flagged("toxic").alias("toxic"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy longest-match pieces of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = token_counts.token_counts(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return out.withColumnRenamed("doc", "doc_id")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    trees = html_extract.fit(html_extract.training_rows(pages))
    return html_extract.extract(pages, trees).withColumnRenamed("page", "page_id")


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document: 3-word shingles, links at 3 or fewer differing bits."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs, shingle=3, max_bits=3).select(
        F.col("doc").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in windows of 1024 ids."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), as_loaded=True).withColumnRenamed("doc", "doc_id")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every document over passages of 50 words that are near-duplicates."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.near_duplicate_passages(docs, keep_links=False)[0].withColumnRenamed("doc", "doc_id")


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that stand in a benchmark window of 13 words, and whose."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    bench = table(spark, sf_dir, "benchmark").select("item_id", "text")
    out = decontaminate.contamination(docs, bench)
    ids = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return out.select(F.col("doc").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(ids, 256).alias("items_sha256"), decontaminate.contaminated().alias("contaminated"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token groups of every document under two tokenizers, its links and their corpus-wide counts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = alignment.align_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return out.withColumnRenamed("doc", "doc_id")


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, one in ten of them looped first."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return periodic_runs.periodic_runs(docs, with_loops=True).withColumnRenamed("doc", "doc_id")


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.find_personal_data(docs, pii.fit_table(pii.labelled_table(spark))).withColumnRenamed("doc", "doc_id")


QUERIES = {f.__name__: f for f in (
    op1_line_dedup, op2_packing, op3_quality_rules, op4_suffix_array_dedup, op5_toxicity, op6_token_counts, op7_html_extraction,
    op8_simhash_near_dedup, op9_substring_dedup, op10_benchmark_decontamination, op11_alignment, op12_periodic_runs, op13_pii)}
