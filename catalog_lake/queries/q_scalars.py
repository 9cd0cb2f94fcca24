"""Scalar functions D1–D29 and predicates F1–F18 over catalogue data."""

from pyspark.sql import functions as F

from catalog_lake.binding import BASE_URL, DEFAULT_SCOPE
from catalog_lake.functions import filters as flt
from catalog_lake.functions import names as nm
from catalog_lake.functions import text as tx
from catalog_lake.queries.registry import register


# -- urls: D1, D2, D28, F4 ---------------------------------------------------
_ID_NAMES = ["manufacturer_id", "model_series_id", "car_type_id", "group_id", "article_id"]


def _url_oracle() -> str:
    n = r"regexp_replace(coalesce(url, ''), '\s+', '', 'g')"
    kind_case = " ".join(f"WHEN regexp_matches(n, '{p}') THEN '{k}'" for k, (p, _) in tx.URL_PATTERNS.items())
    id_cols = []
    for name in _ID_NAMES:
        parts = []
        for k, (p, names) in tx.URL_PATTERNS.items():
            if name in names:
                g = names.index(name) + 1
                parts.append(f"CASE WHEN regexp_matches(n, '{p}') THEN "
                             f"try_cast(nullif(regexp_extract(n, '{p}', {g}), '') AS BIGINT) END")
        id_cols.append(f"coalesce({', '.join(parts)}) AS {name}")
    s = DEFAULT_SCOPE
    scope = (f"regexp_matches(n, '/lang-id-{s['lang_id']}(/|$)') AND "
             f"regexp_matches(n, '/country-filter-id-{s['country_id']}(/|$)') AND "
             f"(regexp_matches(n, '/type-id-{s['type_id']}(/|$)') OR contains(n, '/passenger-car-type-details/'))")
    return f"""
SELECT expected_kind, url, n AS normalized, CASE {kind_case} END AS kind, {', '.join(id_cols)},
       {scope} AS in_scope,
       try_cast(nullif(regexp_extract(url, '{tx.ARTICLE_ID_IN_URL}', 1), '') AS BIGINT) AS article_id_in_url
FROM (SELECT expected_kind, url, {n} AS n FROM catalog_urls) u"""


@register("d1_d2_d28_f4_url_ids", _url_oracle(), ("catalog_urls",))
def d1_d2(t):
    u = t.catalog_urls.withColumn("normalized", tx.normalize_url("url"))
    ids = []
    for name in _ID_NAMES:
        parts = [tx.parse_url_ids("normalized", k, normalized=True)[name]
                 for k, (_, names) in tx.URL_PATTERNS.items() if name in names]
        ids.append(F.coalesce(*parts).alias(name))
    s = DEFAULT_SCOPE
    return u.select("expected_kind", "url", "normalized", tx.url_kind("normalized", normalized=True).alias("kind"),
                    *ids,
                    flt.in_scope("url", s["lang_id"], s["country_id"], s["type_id"]).alias("in_scope"),
                    tx.article_id_from_url("url").alias("article_id_in_url"))


@register("d3_absolutize", """
SELECT expected_kind, href,
       CASE WHEN starts_with(href, 'http://') OR starts_with(href, 'https://') THEN href
            ELSE concat('https://catalog.example/', regexp_replace(href, '^/+', '')) END AS absolute
FROM (SELECT expected_kind, regexp_replace(url, '^https://catalog[.]example', '') AS href
      FROM catalog_urls) x""", ("catalog_urls",))
def d3(t):
    u = t.catalog_urls.select("expected_kind",
                              F.regexp_replace("url", r"^https://catalog[.]example", "").alias("href"))
    return u.select("expected_kind", "href", tx.absolutize(BASE_URL + "/", "href").alias("absolute"))


_SAFE_INT = "CASE WHEN regexp_matches(replace(trim(coalesce({x}, '')), ',', ''), '^[0-9]+$') " \
            "THEN try_cast(replace(trim(coalesce({x}, '')), ',', '') AS BIGINT) END"


def _safe_int_sql(x: str) -> str:
    return _SAFE_INT.format(x=x)


@register("d4_year_range", f"""
SELECT car_type_id, year_range,
       {_safe_int_sql("regexp_extract_all(year_range, '(\\d{4})', 1)[1]")} AS parsed_from,
       {_safe_int_sql("regexp_extract_all(year_range, '(\\d{4})', 1)[2]")} AS parsed_to
FROM car_types""", ("car_types",))
def d4(t):
    yr = tx.year_range("year_range")
    return t.car_types.select("car_type_id", "year_range", yr["year_from"].alias("parsed_from"),
                              yr["year_to"].alias("parsed_to"))


@register("d5_interval_years", f"""
SELECT car_type_id, construction_interval,
  {_safe_int_sql("regexp_extract(construction_interval, '(?i)From[:\\s]+(?:\\d{1,2}[/\\-])?(\\d{4})', 1)")} AS parsed_from,
  {_safe_int_sql("regexp_extract(construction_interval, '(?i)To[:\\s]+(?:\\d{1,2}[/\\-])?(\\d{4})', 1)")} AS parsed_to,
  year_from, year_to
FROM car_type_details""", ("car_type_details",))
def d5(t):
    iv = tx.interval_years("construction_interval")
    return t.car_type_details.select("car_type_id", "construction_interval",
                                     iv["year_from"].alias("parsed_from"), iv["year_to"].alias("parsed_to"),
                                     "year_from", "year_to")


@register("d6_card_dates", """
SELECT article_id, car_type_id, card,
       regexp_extract(card, 'From:\\s*([\\d\\-]+)', 1) AS from_date,
       regexp_extract(card, 'To:\\s*([\\d\\-]+)', 1) AS to_date
FROM (SELECT article_id, car_type_id, concat('From: ', year_from, chr(10), 'To: ', year_to) AS card
      FROM compatible_cars) c""", ("compatible_cars",))
def d6(t):
    c = t.compatible_cars.select("article_id", "car_type_id",
                                 F.concat(F.lit("From: "), "year_from", F.lit("\n"), F.lit("To: "), "year_to")
                                 .alias("card"))
    return c.select("article_id", "car_type_id", "card", tx.labelled_date("card", "From").alias("from_date"),
                    tx.labelled_date("card", "To").alias("to_date"))


_D7_INPUTS = {
    "padded": ("concat(' ', CAST(p_size AS VARCHAR), ' ')",
               lambda: F.concat(F.lit(" "), F.col("p_size").cast("string"), F.lit(" "))),
    "grouped": ("concat(CAST(p_size AS VARCHAR), ',000')",
                lambda: F.concat(F.col("p_size").cast("string"), F.lit(",000"))),
    "decimal": ("CAST(p_retailprice AS VARCHAR)", lambda: F.col("p_retailprice").cast("string")),
    "negative": ("concat('-', CAST(p_size AS VARCHAR))",
                 lambda: F.concat(F.lit("-"), F.col("p_size").cast("string"))),
}


def _to_int_sql(x: str) -> str:
    return f"CASE WHEN regexp_matches(trim({x}), '^[+-]?[0-9]+$') THEN try_cast(trim({x}) AS BIGINT) END"


@register("d7_d8_safe_int_to_int", "SELECT p_partkey, " + ", ".join(
    f"{_safe_int_sql(sql)} AS safe_{k}, {_to_int_sql(sql)} AS int_{k}" for k, (sql, _) in _D7_INPUTS.items())
    + " FROM part")
def d7(t):
    cols = []
    for k, (_, mk) in _D7_INPUTS.items():
        cols += [tx.safe_int(mk()).alias(f"safe_{k}"), tx.to_int(mk()).alias(f"int_{k}")]
    return t.table("part").select("p_partkey", *cols)


@register("d9_d10_d11_d12_d24_null_discipline", """
SELECT a.article_id, coalesce(CAST(d.article_name AS VARCHAR), '') AS article_name_text,
       coalesce(a.is_oem, false) AS is_oem,
       coalesce(len(d.image_urls), 0) AS image_count,
       coalesce(len(coalesce(d.ean_numbers, []::VARCHAR[])), 0) AS ean_count,
       coalesce(CAST(to_json(d.ean_numbers) AS VARCHAR), '[]') AS ean_json,
       coalesce(CAST(to_json(d.oem_numbers) AS VARCHAR), '[]') AS oem_json
FROM articles a LEFT JOIN article_details d USING (article_id)""", ("articles", "article_details"))
def d9(t):
    j = t.articles.join(t.article_details, "article_id", "left")
    return j.select("article_id", tx.to_text("article_name").alias("article_name_text"),
                    tx.bool_default("is_oem").alias("is_oem"),
                    tx.list_size("image_urls").alias("image_count"),
                    tx.list_size(tx.to_list("ean_numbers")).alias("ean_count"),
                    tx.list_json("ean_numbers").alias("ean_json"),
                    tx.list_json("oem_numbers").alias("oem_json"))


@register("d13_dedup_list", """
SELECT article_id, len(image_urls) AS n_images,
       len(list_filter(image_urls, lambda x, i: list_position(image_urls, x) = i)) AS n_distinct,
       array_to_string(list_filter(image_urls, lambda x, i: list_position(image_urls, x) = i), '|')
         AS distinct_urls
FROM article_details""", ("article_details",))
def d13(t):
    d = tx.dedup_list("image_urls")
    return t.article_details.select("article_id", F.array_size("image_urls").cast("bigint").alias("n_images"),
                                    F.array_size(d).cast("bigint").alias("n_distinct"),
                                    F.array_join(d, "|").alias("distinct_urls"))


@register("d16_d17_compact_prefix_keys", """
SELECT model_series_id, name, replace(name, ' ', '') AS compact,
       concat_ws('|', CASE WHEN length(replace(name, ' ', '')) >= 3 THEN substr(replace(name, ' ', ''), 1, 3) END,
                      CASE WHEN length(replace(name, ' ', '')) >= 2 THEN substr(replace(name, ' ', ''), 1, 2) END,
                      CASE WHEN length(replace(name, ' ', '')) >= 1 THEN substr(replace(name, ' ', ''), 1, 1) END)
         AS prefix_keys
FROM (SELECT model_series_id, lower(concat(model_native_name, ' ', display_name)) AS name FROM model_series) m""",
          ("model_series",))
def d16(t):
    m = t.model_series.select("model_series_id",
                              F.lower(F.concat("model_native_name", F.lit(" "), "display_name")).alias("name"))
    c = tx.compact_name("name")
    return m.select("model_series_id", "name", c.alias("compact"),
                    F.array_join(tx.prefix_keys(c), "|").alias("prefix_keys"))


@register("d15_normalize_name", r"""
SELECT name, coalesce(trim(regexp_replace(lower(regexp_replace(strip_accents(name), '[^\x00-\x7F]', '', 'g')),
                                          '[^a-z0-9]+', ' ', 'g')), '') AS normalized
FROM (SELECT manufacturer_name AS name FROM compatible_cars
      UNION SELECT display_name FROM model_series) n""", ("compatible_cars", "model_series"))
def d15(t):
    """NFKD folding (pandas UDF on distinct names); the SQL twin strips accents, which equals
    NFKD for these names; compatibility forms are covered by the brute-force unit test."""
    names = t.compatible_cars.select(F.col("manufacturer_name").alias("name")).unionByName(
        t.model_series.select(F.col("display_name").alias("name"))).distinct()
    return names.select("name", nm.normalize_name("name").alias("normalized"))


@register("d19_d20_d21_d27_card_fragments", """
SELECT a.article_id, a.thumbnail_url, a.part_number, a.article_manufacturer,
       a.article_id AS supplier_id, coalesce(d.article_name, '') AS heading, a.article_manufacturer AS oem_brand
FROM articles a LEFT JOIN article_details d USING (article_id)""", ("articles", "article_details"))
def d19(t):
    """Render card fragments from the articles, parse them back: the oracle is the source."""
    j = t.articles.join(t.article_details.select("article_id", "article_name"), "article_id", "left")
    frag = j.select(
        "article_id",
        F.concat(F.lit("background-image: url('"), "thumbnail_url", F.lit("');")).alias("style"),
        F.concat(F.lit("Article Part No: "), "part_number").alias("pn_text"),
        F.concat(F.lit("Manufacturer "), "article_manufacturer").alias("mf_text"),
        F.concat(F.lit("Supplier ID: "), F.col("article_id").cast("string")).alias("sup_text"),
        F.array(F.lit("AUTO PARTS CATALOG - parts"), F.lit(""), F.lit("Tehnic Details"),
                F.coalesce("article_name", F.lit("")), F.lit("Compatible cars")).alias("headings"),
        F.concat(F.lit("OEM Numbers "), "article_manufacturer", F.lit(":")).alias("oem_key"))
    return frag.select(
        "article_id", tx.css_url("style").alias("thumbnail_url"),
        tx.labelled("pn_text", tx.CARD_LABELS["part_number"]).alias("part_number"),
        tx.labelled("mf_text", tx.CARD_LABELS["article_manufacturer"]).alias("article_manufacturer"),
        tx.labelled("sup_text", tx.CARD_LABELS["supplier_id"], numeric=True).alias("supplier_id"),
        tx.pick_heading("headings").alias("heading"),
        tx.oem_brand("oem_key").alias("oem_brand"))


@register("d22_d23_w9_image_files", """
SELECT article_id, image_index, url,
       CASE WHEN lower(url) LIKE '%.webp' THEN '.webp' WHEN lower(url) LIKE '%.jpg' THEN '.jpg'
            WHEN lower(url) LIKE '%.jpeg' THEN '.jpeg' WHEN lower(url) LIKE '%.png' THEN '.png'
            WHEN lower(url) LIKE '%.gif' THEN '.gif' WHEN lower(url) LIKE '%.avif' THEN '.avif'
            ELSE '.bin' END AS ext
FROM (SELECT article_id, unnest(image_urls) AS url, unnest(range(1, len(image_urls) + 1)) AS image_index
      FROM article_details) x""", ("article_details",))
def d22(t):
    x = t.article_details.select("article_id", F.posexplode("image_urls").alias("pos", "url"))
    return x.select("article_id", (F.col("pos") + 1).cast("bigint").alias("image_index"), "url",
                    tx.guess_ext("url").alias("ext"))


@register("d23_image_paths", """
SELECT article_id, image_index,
       concat(lpad(CAST(article_id % 1000 AS VARCHAR), 3, '0'), '/article_', CAST(article_id AS VARCHAR),
              '_img_', CAST(image_index AS VARCHAR), '.jpg') AS path
FROM (SELECT article_id, unnest(range(1, len(image_urls) + 1)) AS image_index FROM article_details) x""",
          ("article_details",))
def d23(t):
    x = t.article_details.select("article_id", F.posexplode("image_urls").alias("pos", "url"))
    return x.select("article_id", (F.col("pos") + 1).cast("bigint").alias("image_index"),
                    tx.image_path("article_id", F.col("pos") + 1, "url").alias("path"))


# -- predicates ---------------------------------------------------------------
@register("f1_year_gate", """
SELECT car_type_id, year_to FROM car_types WHERE year_to IS NULL OR year_to >= 2006""", ("car_types",))
def f1(t):
    return t.car_types.filter(flt.year_gate("year_to")).select("car_type_id", "year_to")


@register("f2_effective_year_to", """
SELECT car_type_id, coalesce(ct.year_to, d.year_to) AS effective_year_to
FROM car_types ct LEFT JOIN car_type_details d USING (car_type_id)
WHERE (coalesce(ct.year_to, d.year_to) IS NULL OR coalesce(ct.year_to, d.year_to) >= 2006)
  AND coalesce(ct.category_url, '') <> ''""", ("car_types", "car_type_details"))
def f2(t):
    return flt.effective_year_to(t.car_types, t.car_type_details).select("car_type_id", "effective_year_to")


@register("f3_allowlist_exact_compact", """
WITH cand AS (SELECT DISTINCT manufacturer_name AS name,
                     trim(regexp_replace(lower(manufacturer_name), '[^a-z0-9]+', ' ', 'g')) AS normalized
              FROM compatible_cars WHERE manufacturer_name IS NOT NULL),
     allow AS (SELECT DISTINCT trim(regexp_replace(lower(n), '[^a-z0-9]+', ' ', 'g')) AS allowed
               FROM (SELECT CASE WHEN n_nationkey % 3 = 0 THEN replace(n_name, '_', ' ')
                                 WHEN n_nationkey % 3 = 1 THEN replace(n_name, '_', '')
                                 ELSE concat(n_name, 'X') END AS n FROM nation) x),
     pairs AS (SELECT name, normalized, allowed,
                      CASE WHEN normalized = allowed THEN 'exact' ELSE 'compact' END AS match_kind,
                      CASE WHEN normalized = allowed THEN 1 ELSE 2 END AS r
               FROM cand JOIN allow ON replace(normalized, ' ', '') = replace(allowed, ' ', '')
               WHERE normalized <> ''),
     best AS (SELECT name, allowed AS matched_name, match_kind FROM (
                SELECT *, row_number() OVER (PARTITION BY name ORDER BY r, allowed) AS rn FROM pairs) p
              WHERE rn = 1)
SELECT cand.name AS manufacturer_name, cand.normalized, best.matched_name, best.match_kind
FROM cand LEFT JOIN best USING (name)""", ("compatible_cars",))
def f3(t):
    allow = t.table("nation").select(
        F.when(F.col("n_nationkey") % 3 == 0, F.replace("n_name", F.lit("_"), F.lit(" ")))
        .when(F.col("n_nationkey") % 3 == 1, F.replace("n_name", F.lit("_"), F.lit("")))
        .otherwise(F.concat("n_name", F.lit("X"))).alias("name"))
    return nm.allowlist_matches(t.compatible_cars, "manufacturer_name", allow, fuzzy=False)


@register("j9_f3_allowlist_similarity")
def j9(t):
    """Fuzzy allowlist match (ratio needs Python): rows-only; brute force in tests."""
    allow = t.table("nation").select(
        F.when(F.col("n_nationkey") % 3 == 0, F.replace("n_name", F.lit("_"), F.lit(" ")))
        .when(F.col("n_nationkey") % 3 == 1, F.replace("n_name", F.lit("_"), F.lit("")))
        .otherwise(F.concat("n_name", F.lit("X"))).alias("name"))
    cands = t.compatible_cars.select("manufacturer_name").unionByName(
        t.model_series.select(F.col("model_native_name").alias("manufacturer_name")))
    return nm.allowlist_matches(cands, "manufacturer_name", allow, fuzzy=True)


@register("f7_year_overlap_text", """
SELECT article_id, car_type_id, year_from, year_to FROM compatible_cars
WHERE (year_from = '' OR year_from <= '2000') AND (year_to = '' OR year_to >= '2000')""", ("compatible_cars",))
def f7t(t):
    return t.compatible_cars.filter(flt.year_overlap("year_from", "year_to", 2000, "text")) \
        .select("article_id", "car_type_id", "year_from", "year_to")


@register("f7_year_overlap_year", """
SELECT article_id, car_type_id, year_from, year_to FROM compatible_cars
WHERE (year_from = '' OR CAST(substr(year_from, 1, 4) AS INT) <= 2000)
  AND (year_to = '' OR CAST(substr(year_to, 1, 4) AS INT) >= 2000)""", ("compatible_cars",))
def f7y(t):
    return t.compatible_cars.filter(flt.year_overlap("year_from", "year_to", 2000, "year")) \
        .select("article_id", "car_type_id", "year_from", "year_to")


@register("f8_f9_point_lookups", """
SELECT 'car_types_of_model' AS lookup, CAST(car_type_id AS BIGINT) AS id FROM car_types
WHERE model_series_id = (SELECT max(model_series_id) FROM model_series)
UNION ALL
SELECT 'articles_of_car_type_and_group', c.article_id FROM compatible_cars c JOIN articles a USING (article_id)
WHERE c.car_type_id = (SELECT min(car_type_id) FROM car_types) AND a.group_id = (
  SELECT min(a2.group_id) FROM compatible_cars c2 JOIN articles a2 USING (article_id)
  WHERE c2.car_type_id = (SELECT min(car_type_id) FROM car_types))""",
          ("car_types", "model_series", "compatible_cars", "articles"))
def f8(t):
    """Literal lookups: the key is chosen from the data (largest model id, first car type)."""
    ms = t.model_series.agg(F.max("model_series_id")).first()[0]
    ct = t.car_types.agg(F.min("car_type_id")).first()[0]
    from catalog_lake.plans import navigation as nav
    a = nav.car_types(t, ms).select(F.lit("car_types_of_model").alias("lookup"), F.col("car_type_id").alias("id"))
    grp = nav.articles_for(t, ct).agg(F.min("group_id")).first()[0]
    b = nav.articles_for(t, ct, grp).select(F.lit("articles_of_car_type_and_group").alias("lookup"),
                                            F.col("article_id").alias("id"))
    return a.unionByName(b)


@register("f16_category_path", """
SELECT group_id, concat_ws(' > ', nullif(primary_group_name, ''),
         nullif(CASE WHEN subcategory % 3 = 0 THEN '' ELSE subcategory_name END, ''),
         nullif(group_name, '')) AS path
FROM cat_groups""", ("cat_groups",))
def f16(t):
    g = t.groups
    return g.select("group_id", tx.join_nonempty(
        " > ", "primary_group_name",
        F.when(F.col("subcategory") % 3 == 0, F.lit("")).otherwise(F.col("subcategory_name")),
        "group_name").alias("path"))


@register("f17_malformed_first", """
SELECT count(*) FILTER (WHERE oem <> '[]' AND (json_extract(oem, '$[0].brand') IS NULL
                                             OR json_extract(oem, '$[0].number') IS NULL)) AS malformed_oem,
       count(*) FILTER (WHERE tech <> '[]' AND (json_extract(tech, '$[0].brand') IS NULL
                                              OR json_extract(tech, '$[0].number') IS NULL)) AS malformed_tech
FROM (SELECT CAST(to_json(oem_numbers) AS VARCHAR) AS oem, CAST(to_json(technical_details) AS VARCHAR) AS tech
      FROM article_details) d""", ("article_details",))
def f17(t):
    d = t.article_details.select(tx.list_json("oem_numbers").alias("oem"),
                                 tx.list_json("technical_details").alias("tech"))
    return d.agg(F.count_if(flt.malformed_first("oem", ["brand", "number"])).alias("malformed_oem"),
                 F.count_if(flt.malformed_first("tech", ["brand", "number"])).alias("malformed_tech"))


@register("f18_invalid_range_rows", """
SELECT article_id, car_type_id, year_from, year_to FROM compatible_cars
WHERE year_from <> '' AND year_to <> '' AND year_from > year_to""", ("compatible_cars",))
def f18(t):
    return t.compatible_cars.filter(flt.invalid_range("year_from", "year_to")) \
        .select("article_id", "car_type_id", "year_from", "year_to")


@register("d12_d26_json_boundary", """
SELECT article_id, len(technical_details) AS n_pairs,
       array_to_string(list_transform(technical_details, lambda kv: kv.key), '|') AS keys,
       CAST(to_json(technical_details) AS VARCHAR) AS json_text
FROM article_details""", ("article_details",))
def d26(t):
    """Nested list -> JSON text -> parsed back with an explicit schema."""
    j = t.article_details.select("article_id", tx.list_json("technical_details").alias("json_text"))
    parsed = F.from_json("json_text", "array<struct<key:string,value:string>>")
    return j.select("article_id", F.array_size(parsed).cast("bigint").alias("n_pairs"),
                    F.array_join(F.transform(parsed, lambda kv: kv["key"]), "|").alias("keys"), "json_text")
