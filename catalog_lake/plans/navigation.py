"""Served catalogue queries: drill-down navigation and lookups (Q1–Q6, Q8, Q10–Q13).

Every function takes the catalogue ``t`` and an optional key.  With the key
the query is the literal lookup the reference serves (a filter that Parquet
pushdown turns into a row-group skip); with ``None`` it is the batch form that
answers the question for every parent at once, keyed by the parent column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog_lake.functions.text import ilike_contains
from catalog_lake.operators.ordering import paginate_per


def _ordered(df: DataFrame, literal, *order) -> DataFrame:
    """The order of a served list.  The batch form, of every parent at once, is a set: whoever reads
    it takes one parent's rows, and a global sort would cost a sampling pass and a range shuffle of all."""
    return df if literal is None else df.orderBy(*order)


def manufacturers(t, name: str | None = None) -> DataFrame:
    """Q1: manufacturer list, optional case-insensitive contains filter."""
    df = t.manufacturers
    if name:
        df = df.filter(ilike_contains(F.col("manufacturer_name"), name))
    return df.orderBy("manufacturer_name", "manufacturer_id")


def models(t, manufacturer_id: int | None = None) -> DataFrame:
    """Q2: model series of a manufacturer (batch: of every manufacturer)."""
    df = t.model_series
    if manufacturer_id is not None:
        df = df.filter(F.col("manufacturer_id") == manufacturer_id)
    out = df.select("manufacturer_id", "model_series_id", "display_name", "model_native_name", "from_date", "to_date")
    return _ordered(out, manufacturer_id, "display_name", "model_series_id")


def car_types(t, model_series_id: int | None = None) -> DataFrame:
    """Q3: car-type variants of a model series, ordered by start year then label."""
    df = t.car_types
    if model_series_id is not None:
        df = df.filter(F.col("model_series_id") == model_series_id)
    out = df.select("model_series_id", "car_type_id", "type_label", "engine_code", "fuel_type", "year_from", "year_to")
    return _ordered(out, model_series_id, "year_from", "type_label", "car_type_id")


def category_tree(t, car_type_id: int | None = None) -> DataFrame:
    """Q4: three-level category tree of a car type with article counts.

    compat ⋈ articles ⋈ groups, counted per (car type, group).  The group
    dimension is joined *after* the aggregate: the count is keyed by
    group_id already, so the wide join runs on the aggregated rows only.
    """
    compat = t.compatible_cars.select("article_id", "car_type_id")
    if car_type_id is not None:
        compat = compat.filter(F.col("car_type_id") == car_type_id)
    arts = t.articles.select("article_id", "group_id")
    counts = (compat.join(arts, "article_id")
              .groupBy("car_type_id", "group_id")
              .agg(F.count(F.lit(1)).alias("articles")))
    g = t.groups.select(F.col("primary_group_name").alias("category"), "subcategory_name",
                        F.col("group_name").alias("sub_category"), "group_id")
    out = counts.join(g, "group_id").select("car_type_id", "category", "subcategory_name", "sub_category", "group_id", "articles")
    return _ordered(out, car_type_id, "category", "subcategory_name", "sub_category")


def articles_for(t, car_type_id: int | None = None, group_id: int | None = None) -> DataFrame:
    """Q5: articles of a car type within one group (fan-out of compat kept)."""
    compat = t.compatible_cars.select("article_id", "car_type_id")
    arts = t.articles
    if car_type_id is not None:
        compat = compat.filter(F.col("car_type_id") == car_type_id)
    if group_id is not None:
        arts = arts.filter(F.col("group_id") == group_id)
    out = arts.join(compat, "article_id").select("car_type_id", "group_id", "article_id", "part_name", "part_number",
                                                 "article_manufacturer", "is_oem", "thumbnail_url")
    return _ordered(out, car_type_id, "group_id", F.desc("is_oem"), "article_manufacturer", "part_name", "article_id")


def compat_counts(t) -> DataFrame:
    """Compatible-car rows per article, pre-aggregated (J8 decorrelated)."""
    return t.compatible_cars.groupBy("article_id").agg(F.count(F.lit(1)).alias("compat_car_count"))


def article_lists(t, article_id: int | None = None) -> DataFrame:
    """Q6: the four lists of an article's details, empty where it has none or no details."""
    a, d = t.articles.select("article_id"), t.article_details
    if article_id is not None:
        a, d = (x.filter(F.col("article_id") == article_id) for x in (a, d))
    lists = ["ean_numbers", "oem_numbers", "technical_details", "image_urls"]
    return a.join(d.select("article_id", *lists), "article_id", "left") \
        .select("article_id", *[F.coalesce(c, F.array().cast(d.schema[c].dataType)).alias(c) for c in lists])


def article_detail(t, article_id: int | None = None) -> DataFrame:
    """Q6: article ⟕ details with list sizes and the compatible-car count."""
    a = t.articles
    d = t.article_details
    cc = compat_counts(t)
    if article_id is not None:
        a = a.filter(F.col("article_id") == article_id)
        d = d.filter(F.col("article_id") == article_id)
        cc = t.compatible_cars.filter(F.col("article_id") == article_id) \
            .groupBy("article_id").agg(F.count(F.lit(1)).alias("compat_car_count"))
    return (a.join(d, "article_id", "left").join(cc, "article_id", "left")
            .select("article_id", "part_name", "part_number", "article_manufacturer", "group_name",
                    "primary_group_name", "is_oem", "thumbnail_url", "details_url", "article_name",
                    "article_number",
                    F.coalesce(F.array_size("image_urls"), F.lit(0)).cast("bigint").alias("image_count"),
                    F.coalesce(F.array_size("oem_numbers"), F.lit(0)).cast("bigint").alias("oem_count"),
                    F.coalesce(F.array_size("technical_details"), F.lit(0)).cast("bigint").alias("tech_detail_count"),
                    F.coalesce(F.array_size("ean_numbers"), F.lit(0)).cast("bigint").alias("ean_count"),
                    F.coalesce("compat_car_count", F.lit(0)).alias("compat_car_count")))


def car_type_specs(t, car_type_id: int | None = None) -> DataFrame:
    """Q8: car type ⟕ its technical-details page."""
    ct = t.car_types
    ctd = t.car_type_details.select("car_type_id", "car_type_title", "construction_interval",
                                    F.col("details").alias("technical_specs"))
    if car_type_id is not None:
        ct = ct.filter(F.col("car_type_id") == car_type_id)
        ctd = ctd.filter(F.col("car_type_id") == car_type_id)
    return ct.join(ctd, "car_type_id", "left").select(
        "car_type_id", "type_label", "engine_code", "fuel_type", "year_from", "year_to",
        "car_type_title", "construction_interval", "technical_specs")


def compatible_cars(t, article_id: int | None = None, limit: int = 100, offset: int = 0) -> DataFrame:
    """Q10: one page of an article's compatible cars, make, model, start order.

    The batch form pages every article at once with a per-article row number;
    the sort keys are extended with the remaining columns so the page is
    deterministic (the reference has no tie-break).
    """
    if not 1 <= limit <= 1000 or offset < 0:
        raise ValueError("limit must be in 1..1000 and offset >= 0")
    cols = ["car_type_id", "model_series_id", "manufacturer_name", "model_name", "engine_or_variant",
            "year_from", "year_to", "extra_qualifier"]
    df = t.compatible_cars
    if article_id is not None:
        df = df.filter(F.col("article_id") == article_id)
    order = ["manufacturer_name", "model_name", "year_from", "car_type_id", "engine_or_variant",
             "year_to", "model_series_id"]
    return paginate_per(df.select("article_id", *cols), ["article_id"], order, limit, offset)


def makes(t) -> DataFrame:
    """Q11: distinct non-empty makes present in compatibility data."""
    return (t.compatible_cars.select("manufacturer_name").filter(F.col("manufacturer_name") != "")
            .distinct().orderBy("manufacturer_name"))


def models_of_make(t, make: str) -> DataFrame:
    """Q12: distinct non-empty models whose make contains ``make`` (case-insensitive)."""
    return (t.compatible_cars
            .filter(ilike_contains(F.col("manufacturer_name"), make) & (F.col("model_name") != ""))
            .select("model_name").distinct().orderBy("model_name"))


def articles_for_vehicle(t, make: str, model: str) -> DataFrame:
    """Q13: articles fitting a make (case-insensitive equality) and model (contains)."""
    c = t.compatible_cars.filter(F.col("manufacturer_name").ilike(make)
                                 & ilike_contains(F.col("model_name"), model))
    return (c.join(t.articles, "article_id")
            .select("article_id", "part_name", "part_number", "engine_or_variant", "year_from", "year_to"))


def first_article_detail(t) -> DataFrame:
    """DQ 6e: the detail of the smallest article id (deterministic first article)."""
    first = t.articles.agg(F.min("article_id").alias("article_id"))
    return article_detail(t).join(first, "article_id", "left_semi")


