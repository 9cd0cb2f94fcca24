"""Pages, allowlist text and image manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """A10: stored pages ``(page_id, url, html)`` (Parquet)."""
    return spark.read.parquet(path).select("page_id", "url", "html")


def read_allowlist(spark: SparkSession, path: str) -> DataFrame:
    """Allowlist names, one per line; blank and ``#`` lines skipped.

    Decoding: UTF-8 (a byte-order mark is dropped); a file that is not valid
    UTF-8 is read as Latin-1.  The file is read whole by ``binaryFile`` — its
    encoding is a property of the whole file, and it is a hand-kept list.
    """
    raw = spark.read.format("binaryFile").load(path).select("path", "content")
    text = F.when(F.expr("is_valid_utf8(CAST(content AS STRING))"), F.decode("content", "UTF-8")) \
        .otherwise(F.decode("content", "ISO-8859-1"))
    text = F.regexp_replace(text, r"^\x{FEFF}", "")
    lines = raw.select(F.posexplode(F.split(text, r"\r?\n")).alias("line_no", "line"))
    return (lines.withColumn("name", F.trim("line"))
            .filter((F.col("name") != "") & ~F.col("name").startswith("#"))
            .select("line_no", "name"))


def append_manifest(df: DataFrame, path: str) -> None:
    """Append image-manifest rows (JSON lines)."""
    df.write.mode("append").json(path)
