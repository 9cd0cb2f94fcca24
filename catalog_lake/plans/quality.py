"""Data-quality suite.

Each check is a small DataFrame computed with one scan per input where
possible (conditional counts share a scan; coverage uses semi joins instead
of the reference's fan-out join).  ``health_report`` unions them into one
labelled frame; ``verdict`` joins a report to thresholds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog_lake.functions.filters import foreign_urls, invalid_range, malformed_first, year_gate
from catalog_lake.functions.text import is_blank, list_json, pct, url_kind
from catalog_lake.operators import relational as rel

# Fixed values that must equal the reference's acceptance rules (the image
# hosts are this deployment's own: images must come from the catalogue's hosts).
ALLOWED_IMAGE_HOSTS = ["%img.example%", "%cdn.example%"]
THRESHOLDS = [  # (check, comparison, target)
    ("dup_articles", "==", 0.0),
    ("orphan_details", "==", 0.0),
    ("orphan_compat", "==", 0.0),
    ("foreign_images", "==", 0.0),
    ("pct_with_details", ">=", 95.0),
    ("pct_with_cars", ">=", 90.0),
    ("pct_with_thumbnail", ">=", 80.0),
]


def _one(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def summary_counts(t) -> DataFrame:
    """V1: six summary counts in one row (one-row aggregates cross-joined, J10)."""
    c = t.compatible_cars
    return (_one(t.articles, "total_articles")
            .crossJoin(_one(t.article_details, "total_details"))
            .crossJoin(c.agg(F.count(F.lit(1)).alias("total_compat_cars"),
                             F.countDistinct("article_id").alias("articles_with_cars"),
                             F.countDistinct("manufacturer_name").alias("distinct_manufacturers"),
                             F.countDistinct("model_name").alias("distinct_models"))))


COMPAT_DUP_KEY = ["article_id", "car_type_id", "engine_or_variant", "year_from", "year_to"]


def duplicate_keys(t, top: int | None = 20, entities: Sequence[str] = ("articles", "article_details", "compatible_cars")) -> dict[str, DataFrame]:
    """V2: duplicate keys of articles, details and compat rows (expected: none); only the tables of ``entities`` are bound."""
    return {name: rel.duplicates(getattr(t, name), COMPAT_DUP_KEY if name == "compatible_cars" else ["article_id"], top) for name in entities}


def orphan_counts(t) -> DataFrame:
    """V3: details and compat rows without a parent article."""
    return (_one(rel.orphans(t.article_details, t.articles, "article_id"), "orphan_details")
            .crossJoin(_one(rel.orphans(t.compatible_cars, t.articles, "article_id"), "orphan_compat")))


def missing_counts(t) -> DataFrame:
    """V4: articles without details / cars, blank thumbnails, details without images."""
    a = t.articles
    return (_one(rel.orphans(a, t.article_details, "article_id"), "articles_missing_details")
            .crossJoin(_one(rel.orphans(a, t.compatible_cars, "article_id"), "articles_missing_cars"))
            .crossJoin(a.agg(F.count_if(is_blank("thumbnail_url")).cast("bigint").alias("no_thumbnail")))
            .crossJoin(t.article_details.agg(
                F.count_if(F.col("image_urls").isNull() | (F.array_size("image_urls") == 0))
                .cast("bigint").alias("no_images"))))


def coverage_pct(t) -> DataFrame:
    """V5: coverage percentages (details, cars, thumbnails, images)."""
    a = t.articles
    total = _one(a, "total_articles")
    with_details = _one(a.join(t.article_details.select("article_id"), "article_id", "left_semi")
                        .select("article_id").distinct(), "with_details")
    with_cars = t.compatible_cars.agg(F.countDistinct("article_id").alias("with_compat_cars"))
    with_thumb = a.agg(F.count_if(~is_blank("thumbnail_url")).cast("bigint").alias("with_thumbnail"))
    with_img = t.article_details.agg(
        F.count_if(F.col("image_urls").isNotNull() & (F.array_size("image_urls") > 0))
        .cast("bigint").alias("with_images"))
    r = total.crossJoin(with_details).crossJoin(with_cars).crossJoin(with_thumb).crossJoin(with_img)
    for c, p in (("with_details", "pct_with_details"), ("with_compat_cars", "pct_with_cars"),
                 ("with_thumbnail", "pct_with_thumbnail"), ("with_images", "pct_with_images")):
        r = r.withColumn(p, pct(F.col(c), F.col("total_articles")))
    return r


def critical_blanks(t) -> DataFrame:
    """V6: null / empty critical article fields, one scan."""
    return rel.blank_counts(t.articles, {
        "null_article_id": F.col("article_id").isNull(),
        "empty_part_name": is_blank("part_name"),
        "empty_part_number": is_blank("part_number"),
        "empty_details_url": is_blank("details_url"),
        "empty_article_manufacturer": is_blank("article_manufacturer"),
        "null_group_id": F.col("group_id").isNull(),
        "null_is_oem": F.col("is_oem").isNull(),
    })


def foreign_image_count(t, allowed: Sequence[str] = ALLOWED_IMAGE_HOSTS) -> DataFrame:
    """V7: image urls outside the allowed hosts (lateral unnest, J12 + F12)."""
    u = rel.unnest(t.article_details, "image_urls", "url")
    return u.agg(F.count_if(foreign_urls("url", allowed)).cast("bigint").alias("foreign_images"))


def malformed_oem(t) -> DataFrame:
    """V8: non-empty OEM lists whose first element lacks brand or number."""
    return t.article_details.agg(F.count_if(malformed_first(list_json("oem_numbers"), ["brand", "number"]))
                                 .cast("bigint").alias("malformed_oem"))


def missing_make_model(t) -> DataFrame:
    """V9: compat rows with a blank make or model."""
    return t.compatible_cars.agg(F.count_if(is_blank("manufacturer_name") | is_blank("model_name"))
                                 .cast("bigint").alias("missing_make_model"))


def invalid_year_ranges(t) -> DataFrame:
    """Compat rows whose text interval runs backwards."""
    return t.compatible_cars.agg(F.count_if(invalid_range("year_from", "year_to"))
                                 .cast("bigint").alias("invalid_year_range"))


def oem_split(t) -> DataFrame:
    """OEM vs regular articles with share of total."""
    return rel.share_of_total(t.articles, "is_oem")


def manufacturer_coverage(t, top: int | None = 30) -> DataFrame:
    """Per make: distinct models, distinct articles, compat rows; top by articles."""
    g = t.compatible_cars.groupBy("manufacturer_name").agg(
        F.countDistinct("model_name").alias("models"),
        F.countDistinct("article_id").alias("articles"),
        F.count(F.lit(1)).alias("compat_entries"))
    if top is not None:
        g = g.orderBy(F.desc("articles"), "manufacturer_name").limit(top)
    return g


def health_report(t) -> DataFrame:
    """One labelled row per check (U1), values as double.

    Counters of one table come from one aggregate pass over it (compat:
    rows, blank make/model, distinct articles; articles: rows, thumbnails);
    duplicates and orphans add one grouped / anti-join pass each.
    """
    a, d, c = t.articles, t.article_details, t.compatible_cars
    art = a.agg(F.count(F.lit(1)).alias("articles"),
                F.count_if(~is_blank("thumbnail_url")).alias("with_thumbnail"))
    comp = c.agg(F.count(F.lit(1)).alias("compatible_cars"),
                 F.count_if(is_blank("manufacturer_name") | is_blank("model_name")).alias("missing_make_model"),
                 F.countDistinct("article_id").alias("articles_with_cars"))
    det = d.agg(F.count(F.lit(1)).alias("article_details"))
    with_details = a.join(d.select("article_id"), "article_id", "left_semi").select("article_id").distinct() \
        .agg(F.count(F.lit(1)).alias("with_details"))
    dups = (rel.duplicates(a, ["article_id"]).agg(F.count(F.lit(1)).alias("dup_articles"))
            .crossJoin(rel.duplicates(d, ["article_id"]).agg(F.count(F.lit(1)).alias("dup_details"))))
    one = (art.crossJoin(comp).crossJoin(det).crossJoin(with_details).crossJoin(dups)
           .crossJoin(orphan_counts(t)).crossJoin(foreign_image_count(t)))
    total = F.col("articles")
    checks = [("articles", F.col("articles")), ("article_details", F.col("article_details")),
              ("compatible_cars", F.col("compatible_cars")), ("dup_articles", F.col("dup_articles")),
              ("dup_details", F.col("dup_details")), ("orphan_details", F.col("orphan_details")),
              ("orphan_compat", F.col("orphan_compat")), ("foreign_images", F.col("foreign_images")),
              ("missing_make_model", F.col("missing_make_model")),
              ("pct_with_details", pct(F.col("with_details"), total)),
              ("pct_with_cars", pct(F.col("articles_with_cars"), total)),
              ("pct_with_thumbnail", pct(F.col("with_thumbnail"), total))]
    rows = F.array(*[F.struct(F.lit(n).alias("check"), v.cast("double").alias("value")) for n, v in checks])
    return one.select(F.explode(rows).alias("r")).select("r.check", "r.value")


def verdict(report: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Report ⋈ thresholds -> pass/fail per check."""
    j = report.join(thresholds, "check")
    ok = (F.when(F.col("op") == "==", F.col("value") == F.col("target"))
          .when(F.col("op") == ">=", F.col("value") >= F.col("target"))
          .when(F.col("op") == "<=", F.col("value") <= F.col("target")))
    return j.select("check", "value", "op", "target", F.coalesce(ok, F.lit(False)).alias("passed"))


def thresholds_frame(spark) -> DataFrame:
    return spark.createDataFrame(THRESHOLDS, "check string, op string, target double")


def tree_edges(t) -> DataFrame:
    """Orphan count of every parent-child edge of the catalogue tree."""
    return rel.tree_integrity([
        ("model_series->manufacturers", t.model_series, t.manufacturers, "manufacturer_id", "manufacturer_id"),
        ("car_types->model_series", t.car_types, t.model_series, "model_series_id", "model_series_id"),
        ("car_type_details->car_types", t.car_type_details, t.car_types, "car_type_id", "car_type_id"),
        ("articles->groups", t.articles, t.groups, "group_id", "group_id"),
        ("article_details->articles", t.article_details, t.articles, "article_id", "article_id"),
        ("compatible_cars->articles", t.compatible_cars, t.articles, "article_id", "article_id"),
        ("compatible_cars->car_types", t.compatible_cars, t.car_types, "car_type_id", "car_type_id"),
    ])


def year_filter_invariant(t, crawled_car_types: DataFrame, min_year: int = 2006) -> DataFrame:
    """Crawled car types all pass the gate; category rows hanging under gated-out types."""
    below = crawled_car_types.filter(~year_gate("effective_year_to", min_year))
    gated_out = t.car_types.join(crawled_car_types.select("car_type_id"), "car_type_id", "left_anti")
    desc = t.compatible_cars.join(gated_out.select("car_type_id"), "car_type_id", "left_semi")
    return (_one(below, "crawled_below_gate")
            .crossJoin(_one(desc, "compat_rows_under_gated_out")))


def url_parser_coverage(urls: DataFrame) -> DataFrame:
    """Per expected kind, how many urls the parsers recognise as that kind."""
    k = url_kind("url")
    return urls.groupBy("expected_kind").agg(
        F.count(F.lit(1)).alias("urls"),
        F.count_if(k == F.col("expected_kind")).cast("bigint").alias("recognised"),
        F.count_if(k.isNull()).cast("bigint").alias("unrecognised")
    ).withColumn("pct_recognised", pct(F.col("recognised"), F.col("urls")))
