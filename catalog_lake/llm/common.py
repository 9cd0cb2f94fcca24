"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog_lake.session import checkpoint_dir, is_classic, scratch, ship_code

# The blanks between words: space and the five ASCII controls tab to carriage return.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_CLASS = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; every operator query starts here."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Point Spark at the shared checkpoint folder and make this code importable on executors."""
    checkpoint_dir(spark)
    ship_code(spark)


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage at a reliable checkpoint in the shared folder (never a local one)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def written(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``df`` as a Parquet table in the shared folder, which goes at the end of the block."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> None:
    """Let go of the files of shuffles and checkpoints that nothing refers to any more; else they stay until the driver happens to collect its garbage."""
    if is_classic(spark):
        gc.collect()
        spark.sparkContext._jvm.System.gc()


def text_key(text: str | Column) -> Column:
    """128 bits that tell two texts apart; with the document's id they name a row up to exact repeats."""
    c = F.col(text) if isinstance(text, str) else text
    return F.struct(F.xxhash64(c).alias("a"), F.xxhash64(F.lit(1), c).alias("b"))


def is_blank(c: Column) -> Column:
    """No character besides blanks."""
    return F.length(F.translate(c, BLANKS, "")) == 0
