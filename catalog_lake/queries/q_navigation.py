"""Served catalogue queries Q1–Q6, Q8, Q10–Q13 (batch forms over every parent)."""

from catalog_lake.plans import navigation as nav
from catalog_lake.queries.registry import register


@register("q1_manufacturers", """
SELECT manufacturer_id, manufacturer_name FROM manufacturers""", ("manufacturers",))
def q1(t):
    return nav.manufacturers(t)


@register("q1_manufacturers_name_filter", """
SELECT manufacturer_id, manufacturer_name FROM manufacturers
WHERE manufacturer_name ILIKE '%nation_1%'""", ("manufacturers",))
def q1f(t):
    return nav.manufacturers(t, "nation_1")


@register("q2_models_of_manufacturer", """
SELECT manufacturer_id, model_series_id, display_name, model_native_name, from_date, to_date
FROM model_series""", ("model_series",))
def q2(t):
    return nav.models(t)


@register("q3_car_types_of_model", """
SELECT model_series_id, car_type_id, type_label, engine_code, fuel_type, year_from, year_to
FROM car_types""", ("car_types",))
def q3(t):
    return nav.car_types(t)


@register("q4_category_tree", """
SELECT c.car_type_id, g.primary_group_name AS category, g.subcategory_name,
       g.group_name AS sub_category, g.group_id, count(*) AS articles
FROM compatible_cars c JOIN articles a USING (article_id)
     JOIN cat_groups g ON g.group_id = a.group_id
GROUP BY c.car_type_id, g.primary_group_name, g.subcategory_name, g.group_name, g.group_id""",
          ("compatible_cars", "articles", "cat_groups"))
def q4(t):
    return nav.category_tree(t)


@register("q5_articles_of_car_type_and_group", """
SELECT c.car_type_id, a.group_id, a.article_id, a.part_name, a.part_number,
       a.article_manufacturer, a.is_oem, a.thumbnail_url
FROM articles a JOIN compatible_cars c USING (article_id)""", ("articles", "compatible_cars"))
def q5(t):
    return nav.articles_for(t)


_Q6 = """
SELECT a.article_id, a.part_name, a.part_number, a.article_manufacturer, a.group_name,
       a.primary_group_name, a.is_oem, a.thumbnail_url, a.details_url, d.article_name,
       d.article_number,
       coalesce(len(d.image_urls), 0) AS image_count,
       coalesce(len(d.oem_numbers), 0) AS oem_count,
       coalesce(len(d.technical_details), 0) AS tech_detail_count,
       coalesce(len(d.ean_numbers), 0) AS ean_count,
       coalesce(cc.n, 0) AS compat_car_count
FROM articles a LEFT JOIN article_details d USING (article_id)
     LEFT JOIN (SELECT article_id, count(*) AS n FROM compatible_cars GROUP BY article_id) cc
       USING (article_id)"""


@register("q6_article_detail", _Q6, ("articles", "article_details", "compatible_cars"))
def q6(t):
    return nav.article_detail(t)


@register("q6_article_lists", """
SELECT a.article_id, coalesce(array_to_string(ean_numbers, '|'), '') AS eans, coalesce(array_to_string(image_urls, '|'), '') AS images,
       coalesce(array_to_string(list_transform(oem_numbers, lambda o: concat(o.brand, ':', o.number)), '|'), '') AS oems,
       coalesce(array_to_string(list_transform(technical_details, lambda kv: concat(kv.key, '=', kv.value)), '|'), '') AS tech
FROM articles a LEFT JOIN article_details d USING (article_id)""", ("articles", "article_details"))
def q6_lists(t):
    from pyspark.sql import functions as F
    pair = lambda x, a, b, sep: F.transform(x, lambda y: F.concat(y[a], F.lit(sep), y[b]))
    return nav.article_lists(t).select(
        "article_id", F.array_join("ean_numbers", "|").alias("eans"), F.array_join("image_urls", "|").alias("images"),
        F.array_join(pair("oem_numbers", "brand", "number", ":"), "|").alias("oems"),
        F.array_join(pair("technical_details", "key", "value", "="), "|").alias("tech"))


@register("q6_first_article_detail", _Q6 + """
WHERE a.article_id = (SELECT min(article_id) FROM articles)""",
          ("articles", "article_details", "compatible_cars"))
def q6_first(t):
    return nav.first_article_detail(t)


@register("q8_car_type_specs", """
SELECT ct.car_type_id, ct.type_label, ct.engine_code, ct.fuel_type, ct.year_from, ct.year_to,
       ctd.car_type_title, ctd.construction_interval, CAST(to_json(ctd.details) AS VARCHAR) AS technical_specs
FROM car_types ct LEFT JOIN car_type_details ctd USING (car_type_id)""",
          ("car_types", "car_type_details"))
def q8(t):
    """Specs served as JSON text (as the reference's API returns them)."""
    from pyspark.sql import functions as F
    return nav.car_type_specs(t).withColumn("technical_specs", F.to_json("technical_specs"))


@register("q10_compatible_cars_page", """
SELECT * FROM (
  SELECT article_id, car_type_id, model_series_id, manufacturer_name, model_name,
         engine_or_variant, year_from, year_to, extra_qualifier,
         CAST(row_number() OVER (PARTITION BY article_id ORDER BY manufacturer_name, model_name,
              year_from, car_type_id, engine_or_variant, year_to, model_series_id) AS BIGINT) AS position
  FROM compatible_cars) x
WHERE position <= 100""", ("compatible_cars",))
def q10(t):
    return nav.compatible_cars(t, limit=100)


@register("q10_compatible_cars_page2", """
SELECT * FROM (
  SELECT article_id, car_type_id, model_series_id, manufacturer_name, model_name,
         engine_or_variant, year_from, year_to, extra_qualifier,
         CAST(row_number() OVER (PARTITION BY article_id ORDER BY manufacturer_name, model_name,
              year_from, car_type_id, engine_or_variant, year_to, model_series_id) AS BIGINT) AS position
  FROM compatible_cars) x
WHERE position > 20 AND position <= 40""", ("compatible_cars",))
def q10b(t):
    return nav.compatible_cars(t, limit=20, offset=20)


@register("q11_makes", """
SELECT DISTINCT manufacturer_name FROM compatible_cars WHERE manufacturer_name <> ''""",
          ("compatible_cars",))
def q11(t):
    return nav.makes(t)


@register("q12_models_of_make", """
SELECT DISTINCT model_name FROM compatible_cars
WHERE manufacturer_name ILIKE '%nation_2%' AND model_name <> ''""", ("compatible_cars",))
def q12(t):
    return nav.models_of_make(t, "nation_2")


@register("q13_articles_for_vehicle", """
SELECT a.article_id, a.part_name, a.part_number, c.engine_or_variant, c.year_from, c.year_to
FROM compatible_cars c JOIN articles a USING (article_id)
WHERE c.manufacturer_name ILIKE 'nation_3' AND c.model_name ILIKE '%#0000001%'""",
          ("compatible_cars", "articles"))
def q13(t):
    return nav.articles_for_vehicle(t, "nation_3", "#0000001")
