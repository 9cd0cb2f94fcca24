"""Corpus pipeline: quality rules, line dedup, near duplicates, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept.
All but the last return the columns of ``documents``.  ``run`` writes every stage as
Parquet in the shared checkpoint folder, so a lost executor costs one stage's tasks.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog_lake.llm import decontaminate, line_dedup, packing, quality, simhash
from catalog_lake.llm.common import prepare, table
from catalog_lake.session import checkpoint_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the threshold table keeps."""
    prepare(spark)
    return quality.keep_good(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its text without cross-site boilerplate lines and n_chars to match."""
    prepare(spark)
    out = line_dedup.clean_lines(docs)
    return out.withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), F.col("n_chars")))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: 3-word shingles, 3 or fewer differing bits."""
    prepare(spark)
    return simhash.keep_one(docs, shingle=3, max_bits=3)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold too little of any benchmark item to count as contaminated."""
    prepare(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in windows of 1024 ids."""
    prepare(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), as_loaded=True).withColumnRenamed("doc", "doc_id")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("packing", pack),
]

#: Fingerprints, tokenizer ids and packing have no SQL; tests/llm compares each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply every stage to ``documents``; the rows of the last one."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
