"""Data-quality suite V1–V18 and dimension backfill K5/K7 (+ V14)."""


from types import SimpleNamespace

from pyspark.sql import functions as F

from catalog_lake.plans import backfill as bf
from catalog_lake.plans import quality as dq
from catalog_lake.queries.registry import register

A, D, C = "articles", "article_details", "compatible_cars"


@register("v1_summary_counts", """
SELECT (SELECT count(*) FROM articles) AS total_articles,
       (SELECT count(*) FROM article_details) AS total_details,
       (SELECT count(*) FROM compatible_cars) AS total_compat_cars,
       (SELECT count(DISTINCT article_id) FROM compatible_cars) AS articles_with_cars,
       (SELECT count(DISTINCT manufacturer_name) FROM compatible_cars) AS distinct_manufacturers,
       (SELECT count(DISTINCT model_name) FROM compatible_cars) AS distinct_models""", (A, D, C))
def v1(t):
    return dq.summary_counts(t)


@register("v2_duplicate_articles", """
SELECT article_id, count(*) AS n FROM articles GROUP BY article_id HAVING count(*) > 1
ORDER BY n DESC, article_id LIMIT 20""", (A,))
def v2a(t):
    return dq.duplicate_keys(t, entities=[A])[A]


@register("v2_duplicate_details", """
SELECT article_id, count(*) AS n FROM article_details GROUP BY article_id HAVING count(*) > 1
ORDER BY n DESC, article_id LIMIT 20""", (D,))
def v2b(t):
    return dq.duplicate_keys(t, entities=[D])[D]


@register("v2_planted_duplicates", """
SELECT 'articles' AS entity, article_id, CASE WHEN article_id % 20 = 0 THEN 3 ELSE 2 END AS n FROM articles WHERE article_id % 10 = 0
UNION ALL SELECT 'article_details', article_id, 2 FROM article_details WHERE article_id % 15 = 0""", (A, D))
def v2p(t):
    """Articles and details of which some came two or three times."""
    a, d = t.articles, t.article_details
    twice = SimpleNamespace(articles=a.unionByName(a.filter("article_id % 10 = 0")).unionByName(a.filter("article_id % 20 = 0")),
                            article_details=d.unionByName(d.filter("article_id % 15 = 0")))
    found = dq.duplicate_keys(twice, top=None, entities=[A, D])
    return found["articles"].unionByName(found["article_details"].withColumn("entity", F.lit("article_details")), allowMissingColumns=True) \
        .select(F.coalesce("entity", F.lit("articles")).alias("entity"), "article_id", F.col("n").cast("int"))


@register("v2_g3_duplicate_compat_rows", """
SELECT article_id, car_type_id, engine_or_variant, year_from, year_to, count(*) AS n
FROM compatible_cars GROUP BY article_id, car_type_id, engine_or_variant, year_from, year_to
HAVING count(*) > 1""", (C,))
def v2c(t):
    """All duplicate five-column keys (the full G3 group, no top-k)."""
    return dq.duplicate_keys(t, top=None, entities=[C])[C]


@register("v2_duplicate_compat_top20", """
SELECT article_id, car_type_id, engine_or_variant, year_from, year_to, count(*) AS n
FROM compatible_cars GROUP BY article_id, car_type_id, engine_or_variant, year_from, year_to
HAVING count(*) > 1
ORDER BY n DESC, article_id, car_type_id, engine_or_variant, year_from, year_to LIMIT 20""", (C,))
def v2d(t):
    return dq.duplicate_keys(t, top=20, entities=[C])[C]


@register("v3_j4_orphans", """
SELECT (SELECT count(*) FROM article_details d LEFT JOIN articles a USING (article_id)
        WHERE a.article_id IS NULL) AS orphan_details,
       (SELECT count(*) FROM compatible_cars c LEFT JOIN articles a USING (article_id)
        WHERE a.article_id IS NULL) AS orphan_compat""", (A, D, C))
def v3(t):
    return dq.orphan_counts(t)


@register("v4_missing", """
SELECT (SELECT count(*) FROM articles a LEFT JOIN article_details d USING (article_id)
        WHERE d.article_id IS NULL) AS articles_missing_details,
       (SELECT count(*) FROM articles a WHERE NOT EXISTS (
          SELECT 1 FROM compatible_cars c WHERE c.article_id = a.article_id)) AS articles_missing_cars,
       (SELECT count(*) FROM articles WHERE thumbnail_url IS NULL OR thumbnail_url = '') AS no_thumbnail,
       (SELECT count(*) FROM article_details WHERE image_urls IS NULL OR len(image_urls) = 0) AS no_images""",
          (A, D, C))
def v4(t):
    return dq.missing_counts(t)


@register("v5_j10_coverage", """
SELECT total.n AS total_articles, hd.n AS with_details,
       round(CAST(hd.n AS DOUBLE) * 100.0 / total.n, 1) AS pct_with_details,
       hc.n AS with_compat_cars, round(CAST(hc.n AS DOUBLE) * 100.0 / total.n, 1) AS pct_with_cars,
       ht.n AS with_thumbnail, round(CAST(ht.n AS DOUBLE) * 100.0 / total.n, 1) AS pct_with_thumbnail,
       hi.n AS with_images, round(CAST(hi.n AS DOUBLE) * 100.0 / total.n, 1) AS pct_with_images
FROM (SELECT count(*) AS n FROM articles) total,
     (SELECT count(DISTINCT a.article_id) AS n FROM articles a JOIN article_details d USING (article_id)) hd,
     (SELECT count(DISTINCT article_id) AS n FROM compatible_cars) hc,
     (SELECT count(*) AS n FROM articles WHERE thumbnail_url IS NOT NULL AND thumbnail_url <> '') ht,
     (SELECT count(*) AS n FROM article_details WHERE image_urls IS NOT NULL AND len(image_urls) > 0) hi""",
          (A, D, C))
def v5(t):
    return dq.coverage_pct(t)


@register("v6_g5_critical_blanks", """
SELECT count(*) FILTER (WHERE article_id IS NULL) AS null_article_id,
       count(*) FILTER (WHERE part_name IS NULL OR part_name = '') AS empty_part_name,
       count(*) FILTER (WHERE part_number IS NULL OR part_number = '') AS empty_part_number,
       count(*) FILTER (WHERE details_url IS NULL OR details_url = '') AS empty_details_url,
       count(*) FILTER (WHERE article_manufacturer IS NULL OR article_manufacturer = '')
         AS empty_article_manufacturer,
       count(*) FILTER (WHERE group_id IS NULL) AS null_group_id,
       count(*) FILTER (WHERE is_oem IS NULL) AS null_is_oem
FROM articles""", (A,))
def v6(t):
    return dq.critical_blanks(t)


@register("v7_j12_f12_image_hosts", """
SELECT count(*) AS foreign_images FROM (SELECT unnest(image_urls) AS url FROM article_details) u
WHERE url NOT LIKE '%img.example%' AND url NOT LIKE '%cdn.example%' AND url <> ''""", (D,))
def v7(t):
    return dq.foreign_image_count(t)


@register("v7_image_hosts_cdn_policy", """
SELECT count(*) AS foreign_images FROM (SELECT unnest(image_urls) AS url FROM article_details) u
WHERE url NOT LIKE '%img.example%' AND url <> ''""", (D,))
def v7b(t):
    """The same policy check with this catalogue's own image host allowed."""
    return dq.foreign_image_count(t, ["%img.example%"])


@register("v8_malformed_oem", """
SELECT count(*) FILTER (WHERE j <> '[]' AND (json_extract(j, '$[0].brand') IS NULL
                                           OR json_extract(j, '$[0].number') IS NULL)) AS malformed_oem
FROM (SELECT coalesce(CAST(to_json(oem_numbers) AS VARCHAR), '[]') AS j FROM article_details) d""", (D,))
def v8(t):
    return dq.malformed_oem(t)


@register("v9_missing_make_model", """
SELECT count(*) AS missing_make_model FROM compatible_cars
WHERE manufacturer_name IS NULL OR manufacturer_name = '' OR model_name IS NULL OR model_name = ''""", (C,))
def v9(t):
    return dq.missing_make_model(t)


@register("v10_invalid_year_range", """
SELECT count(*) AS invalid_year_range FROM compatible_cars
WHERE year_from <> '' AND year_to <> '' AND year_from > year_to""", (C,))
def v10(t):
    return dq.invalid_year_ranges(t)


@register("v11_g6_w3_oem_split", """
SELECT is_oem, count(*) AS count,
       round(CAST(count(*) AS DOUBLE) * 100.0 / sum(count(*)) OVER (), 1) AS pct
FROM articles GROUP BY is_oem""", (A,))
def v11(t):
    return dq.oem_split(t)


@register("v12_g7_manufacturer_coverage", """
SELECT manufacturer_name, count(DISTINCT model_name) AS models, count(DISTINCT article_id) AS articles,
       count(*) AS compat_entries
FROM compatible_cars GROUP BY manufacturer_name ORDER BY articles DESC, manufacturer_name LIMIT 30""", (C,))
def v12(t):
    return dq.manufacturer_coverage(t)


_HEALTH = """
SELECT 'articles' AS "check", CAST(count(*) AS DOUBLE) AS value FROM articles
UNION ALL SELECT 'article_details', count(*) FROM article_details
UNION ALL SELECT 'compatible_cars', count(*) FROM compatible_cars
UNION ALL SELECT 'dup_articles', count(*) FROM (SELECT article_id FROM articles GROUP BY article_id
                                                HAVING count(*) > 1) x
UNION ALL SELECT 'dup_details', count(*) FROM (SELECT article_id FROM article_details GROUP BY article_id
                                               HAVING count(*) > 1) x
UNION ALL SELECT 'orphan_details', count(*) FROM article_details d LEFT JOIN articles a USING (article_id)
                                            WHERE a.article_id IS NULL
UNION ALL SELECT 'orphan_compat', count(*) FROM compatible_cars c LEFT JOIN articles a USING (article_id)
                                           WHERE a.article_id IS NULL
UNION ALL SELECT 'foreign_images', count(*) FROM (SELECT unnest(image_urls) AS url FROM article_details) u
          WHERE url NOT LIKE '%img.example%' AND url NOT LIKE '%cdn.example%' AND url <> ''
UNION ALL SELECT 'missing_make_model', count(*) FROM compatible_cars
          WHERE manufacturer_name IS NULL OR manufacturer_name = '' OR model_name IS NULL OR model_name = ''
UNION ALL SELECT 'pct_with_details', round(CAST((SELECT count(DISTINCT article_id) FROM articles
          JOIN article_details USING (article_id)) AS DOUBLE) * 100.0 / (SELECT count(*) FROM articles), 1)
UNION ALL SELECT 'pct_with_cars', round(CAST((SELECT count(DISTINCT article_id) FROM compatible_cars) AS DOUBLE)
          * 100.0 / (SELECT count(*) FROM articles), 1)
UNION ALL SELECT 'pct_with_thumbnail', round(CAST((SELECT count(*) FROM articles WHERE thumbnail_url <> '')
          AS DOUBLE) * 100.0 / (SELECT count(*) FROM articles), 1)"""


@register("v13_u1_health_report", _HEALTH, (A, D, C))
def v13(t):
    return dq.health_report(t)


@register("v18_verdict", """
WITH report AS (""" + _HEALTH + """),
thresholds AS (SELECT * FROM (VALUES ('dup_articles', '==', 0.0), ('orphan_details', '==', 0.0),
    ('orphan_compat', '==', 0.0), ('foreign_images', '==', 0.0), ('pct_with_details', '>=', 95.0),
    ('pct_with_cars', '>=', 90.0), ('pct_with_thumbnail', '>=', 80.0)) v("check", op, target))
SELECT r."check", r.value, t.op, CAST(t.target AS DOUBLE) AS target,
       CASE WHEN t.op = '==' THEN r.value = t.target ELSE r.value >= t.target END AS passed
FROM report r JOIN thresholds t USING ("check")""", (A, D, C))
def v18(t):
    return dq.verdict(dq.health_report(t), dq.thresholds_frame(t.spark))


@register("v15_j14_tree_edges", """
SELECT 'model_series->manufacturers' AS edge, count(*) AS orphans FROM model_series
  WHERE manufacturer_id IS NOT NULL AND manufacturer_id NOT IN (SELECT manufacturer_id FROM manufacturers)
UNION ALL SELECT 'car_types->model_series', count(*) FROM car_types
  WHERE model_series_id IS NOT NULL AND model_series_id NOT IN (SELECT model_series_id FROM model_series)
UNION ALL SELECT 'car_type_details->car_types', count(*) FROM car_type_details
  WHERE car_type_id IS NOT NULL AND car_type_id NOT IN (SELECT car_type_id FROM car_types)
UNION ALL SELECT 'articles->groups', count(*) FROM articles
  WHERE group_id IS NOT NULL AND group_id NOT IN (SELECT group_id FROM cat_groups)
UNION ALL SELECT 'article_details->articles', count(*) FROM article_details
  WHERE article_id IS NOT NULL AND article_id NOT IN (SELECT article_id FROM articles)
UNION ALL SELECT 'compatible_cars->articles', count(*) FROM compatible_cars
  WHERE article_id IS NOT NULL AND article_id NOT IN (SELECT article_id FROM articles)
UNION ALL SELECT 'compatible_cars->car_types', count(*) FROM compatible_cars
  WHERE car_type_id IS NOT NULL AND car_type_id NOT IN (SELECT car_type_id FROM car_types)""",
          ("manufacturers", "model_series", "car_types", "car_type_details", "cat_groups", A, D, C))
def v15(t):
    return dq.tree_edges(t)


@register("v16_year_filter_invariant", """
SELECT (SELECT count(*) FROM crawled_ct WHERE effective_year_to < 2006) AS crawled_below_gate,
       (SELECT count(*) FROM compatible_cars WHERE car_type_id IN (
          SELECT car_type_id FROM car_types WHERE car_type_id NOT IN (SELECT car_type_id FROM crawled_ct)))
         AS compat_rows_under_gated_out""", ("crawled_ct", "car_types", C))
def v16(t):
    return dq.year_filter_invariant(t, bf.crawled_dimensions(t)["car_types"])


@register("v17_g5_url_parser_coverage", """
SELECT expected_kind, count(*) AS urls, count(*) FILTER (WHERE kind = expected_kind) AS recognised,
       count(*) FILTER (WHERE kind IS NULL) AS unrecognised,
       round(CAST(count(*) FILTER (WHERE kind = expected_kind) AS DOUBLE) * 100.0 / count(*), 1) AS pct_recognised
FROM (SELECT expected_kind, CASE
        WHEN regexp_matches(n, '/models/manufacturer-id-(\\d+)/') THEN 'manufacturer'
        WHEN regexp_matches(n, '/passenger-car-types/(\\d+)/manufacturer-id-(\\d+)/') THEN 'model_series'
        WHEN regexp_matches(n, '/passenger-car-type-details/(\\d+)/manufacturer-id-(\\d+)/') THEN 'car_type_details'
        WHEN regexp_matches(n, '/list-category-products-groups/(\\d+)/manufacturer-id-(\\d+)/') THEN 'category_page'
        WHEN regexp_matches(n, '/list-articles/(\\d+)/(\\d+)/manufacturer-id-(\\d+)/') THEN 'list_articles'
        WHEN regexp_matches(n, '/list-oem-articles/(\\d+)/(\\d+)/manufacturer-id-(\\d+)/') THEN 'list_oem_articles'
        WHEN regexp_matches(n, '/article-details/(\\d+)/model-series-id-(\\d+)/manufacturer-id-(\\d+)/')
          THEN 'article_details' END AS kind
      FROM (SELECT expected_kind, regexp_replace(coalesce(url, ''), '\\s+', '', 'g') AS n FROM catalog_urls) u) k
GROUP BY expected_kind""", ("catalog_urls",))
def v17(t):
    return dq.url_parser_coverage(t.catalog_urls)


# -- backfill ------------------------------------------------------------------
def _backfilled(t):
    d = bf.crawled_dimensions(t)
    return bf.backfill_dimensions(d["manufacturers"], d["model_series"], d["car_types"], t.compatible_cars)


@register("k7_w4_backfill_manufacturers", "SELECT manufacturer_id, manufacturer_name FROM bf_mf", ("bf_mf",))
def k7a(t):
    return _backfilled(t)["manufacturers"].select("manufacturer_id", "manufacturer_name")


@register("k7_w6_k5_backfill_model_series", "SELECT model_series_id, manufacturer_id, display_name FROM bf_ms",
          ("bf_ms",))
def k7b(t):
    return _backfilled(t)["model_series"].select("model_series_id", "manufacturer_id", "display_name")


@register("k7_backfill_car_types", "SELECT car_type_id, model_series_id, type_label FROM bf_ct", ("bf_ct",))
def k7c(t):
    return _backfilled(t)["car_types"].select("car_type_id", "model_series_id", "type_label")


_GAPS = """
SELECT (SELECT count(DISTINCT car_type_id) FROM compatible_cars) AS compat_car_types,
       (SELECT count(DISTINCT car_type_id) FROM compatible_cars WHERE car_type_id IN (SELECT car_type_id FROM {ct}))
         AS dimension_car_types,
       (SELECT count(*) FROM {ms} WHERE manufacturer_id IS NULL) AS model_series_null_manufacturer,
       (SELECT count(*) FROM (SELECT DISTINCT manufacturer_name FROM compatible_cars) x
        WHERE NOT EXISTS (SELECT 1 FROM {mf} m WHERE m.manufacturer_name = x.manufacturer_name))
         AS missing_manufacturer_names"""


@register("v14_dimension_gaps_before", _GAPS.format(ct="crawled_ct", ms="crawled_ms", mf="crawled_mf"),
          ("crawled_ct", "crawled_ms", "crawled_mf", C))
def v14a(t):
    d = bf.crawled_dimensions(t)
    return bf.dimension_gaps(d["manufacturers"], d["model_series"], d["car_types"], t.compatible_cars)


@register("v14_dimension_gaps_after", _GAPS.format(ct="bf_ct", ms="bf_ms", mf="bf_mf"),
          ("bf_ct", "bf_ms", "bf_mf", C))
def v14b(t):
    b = _backfilled(t)
    return bf.dimension_gaps(b["manufacturers"], b["model_series"], b["car_types"], t.compatible_cars)


@register("v14_g13_top_missing_names", """
SELECT manufacturer_name, count(DISTINCT article_id) AS n FROM compatible_cars
WHERE manufacturer_name IS NOT NULL AND manufacturer_name NOT IN (SELECT manufacturer_name FROM crawled_mf)
GROUP BY manufacturer_name ORDER BY n DESC, manufacturer_name LIMIT 10""", ("crawled_mf", C))
def v14c(t):
    return bf.top_missing_names(bf.crawled_dimensions(t)["manufacturers"], t.compatible_cars)

