"""Cross-site boilerplate lines: one HyperLogLog sketch of sites per line, exact counts near the threshold.

Everything is DataFrame expressions.  Lines are named by a 128-bit hash, so the text of a
line is never shuffled for counting.  The sketches are built map-side and merged by the
aggregation, so a line that stands in a third of all rows costs one small sketch per task.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog_lake.llm.common import BLANKS, cut, text_key

MIN_SITES = 10
LG_K = 12


def line_table(docs: DataFrame, doc: str = "doc_id", text: str = "text", site: str = "source") -> DataFrame:
    """(doc, th, site, place, key) of every line with a word, cut to the shared folder.

    The texts are split and hashed once; the key is the hash of the line without the
    blanks around it, so nothing that follows reads a text again.
    """
    lines = docs.select(F.col(doc).alias("doc"), text_key(text).alias("th"), F.col(site).cast("string").alias("site"),
                        F.posexplode(F.split(text, "\n")).alias("place", "line"))
    trimmed = F.trim(F.col("line"), F.lit(BLANKS))
    return cut(lines.where(F.length(trimmed) > 0).select("doc", "th", "site", "place", text_key(trimmed).alias("key")))


def sketch_error(min_sites: int, lg_k: int) -> float:
    """Half the width of the band whose lines are counted exactly: 6 standard errors, 2 sites at least."""
    return max(2.0, 6 * 1.04 / math.sqrt(2 ** lg_k) * min_sites)


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K) -> DataFrame:
    """(key, first_doc) of the lines of a ``line_table`` found on at least ``min_sites`` distinct sites.

    A sketch's estimate outside the band decides; inside it the line's distinct sites are
    counted exactly.  Rows without a site count for no site.
    """
    band = sketch_error(min_sites, lg_k)
    spread = lines.groupBy("key").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(lg_k))).alias("sites"), F.min("doc").alias("first_doc"))
    sure = spread.where(F.col("sites") > min_sites + band).select("key", "first_doc")
    near = spread.where((F.col("sites") >= min_sites - band) & (F.col("sites") <= min_sites + band)).select("key")
    exact = lines.select("key", "site").join(near, "key", "left_semi").distinct() \
        .groupBy("key").agg(F.count("site").alias("sites")).where(F.col("sites") >= min_sites).select("key")
    exact = spread.select("key", "first_doc").join(exact, "key", "left_semi")
    return sure.unionByName(exact)


def remove_boilerplate(docs: DataFrame, doc: str = "doc_id", text: str = "text", site: str = "source",
                       min_sites: int = MIN_SITES, lg_k: int = LG_K) -> DataFrame:
    """``row`` with ``n_lines``, ``n_removed`` and ``clean``, the text without its boilerplate lines.

    A boilerplate line stays in the document with the smallest id that has it (all its
    places there) and goes everywhere else, so no content leaves the corpus altogether.
    Lines compare without the blanks around them; blank lines always stay.  Texts without
    a removed line come back unchanged, a null text stays null with no lines.  Rows come
    out one for one; repeated rows are treated alike, and a row without an id is never
    the first.  Only places of removed lines are joined back, not lines.
    """
    lines = line_table(docs, doc, text, site)
    hits = lines.drop("site").join(boilerplate(lines, min_sites, lg_k), "key") \
        .where(F.col("doc").isNull() | F.col("first_doc").isNull() | (F.col("doc") > F.col("first_doc"))) \
        .groupBy("doc", "th").agg(F.collect_set("place").alias("gone"))
    left = docs.select(F.struct("*").alias("row")).select(
        "row", F.col("row")[doc].alias("doc"), text_key(F.col("row")[text]).alias("th"))
    hits = hits.select(F.col("doc").alias("hit_doc"), F.col("th").alias("hit_th"), "gone")
    joined = left.join(hits, F.col("th").eqNullSafe(F.col("hit_th")) & F.col("doc").eqNullSafe(F.col("hit_doc")), "left")
    split = joined.select("row", "gone", F.split(F.col("row")[text], "\n").alias("lines"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    text_of = F.array_join(F.transform(kept, lambda i: F.get(F.col("lines"), i)), "\n")
    return split.select(
        "row", F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.when(F.col("gone").isNull(), F.col("row")[text]).otherwise(text_of).alias("clean"))


def clean_lines(docs: DataFrame, doc: str = "doc_id", text: str = "text", site: str = "source",
                min_sites: int = MIN_SITES) -> DataFrame:
    """The documents with their own columns, the text without cross-site boilerplate."""
    out = remove_boilerplate(docs, doc, text, site, min_sites)
    return out.select(*[F.col("clean").alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns])
