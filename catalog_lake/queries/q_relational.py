"""Keep-one windows (W), keyed maintenance (K1–K6, K8), counters (G9–G15), set ops (U), J7/J13."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog_lake.operators import dedup as dd
from catalog_lake.operators import relational as rel
from catalog_lake.operators import upsert as up
from catalog_lake.operators.keyed_table import KeyedTable
from catalog_lake.operators.ordering import SortedPages
from catalog_lake.plans import backfill as bf
from catalog_lake.plans import rounds as rd
from catalog_lake.queries.registry import register
from catalog_lake.session import scratch
from catalog_lake.streaming import incremental as inc

A, D, C = "articles", "article_details", "compatible_cars"
_RNUM = "CAST(regexp_extract(round_label, '(\\d+)', 1) AS BIGINT)"


@register("w2_keep_newest_round", f"""
SELECT pk, round_label, row_pos, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY pk ORDER BY {_RNUM} DESC NULLS LAST, row_pos ASC) AS rn
  FROM rounds) x WHERE rn = 1""", ("rounds",))
def w2(t):
    return dd.keep_round(t.rounds, "pk", policy="newest").select("pk", "round_label", "row_pos", "event_type",
                                                                   "value")


@register("w2_keep_oldest_round", f"""
SELECT pk, round_label, row_pos, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY pk ORDER BY {_RNUM} ASC NULLS LAST, row_pos ASC) AS rn
  FROM rounds) x WHERE rn = 1""", ("rounds",))
def w2o(t):
    return dd.keep_round(t.rounds, "pk", policy="oldest").select("pk", "round_label", "row_pos", "event_type",
                                                                   "value")


@register("w1_w7_keep_one_per_key", """
SELECT article_id, car_type_id, engine_or_variant, year_from, year_to FROM (
  SELECT *, row_number() OVER (PARTITION BY article_id, car_type_id
                               ORDER BY engine_or_variant, year_from, year_to) AS rn
  FROM compatible_cars) x WHERE rn = 1""", (C,))
def w1(t):
    return dd.keep_one(t.compatible_cars, ["article_id", "car_type_id"],
                       ["engine_or_variant", "year_from", "year_to"]) \
        .select("article_id", "car_type_id", "engine_or_variant", "year_from", "year_to")


@register("d14_first_per_page", """
SELECT round_label, pk, row_pos, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY round_label, pk ORDER BY row_pos) AS rn
  FROM rounds WHERE pk IS NOT NULL) x WHERE rn = 1""", ("rounds",))
def d14(t):
    return dd.first_per_page(t.rounds, "round_label", "pk", "row_pos") \
        .select("round_label", "pk", "row_pos", "event_type")


@register("w5_t1_first_n_per_parent", """
SELECT model_series_id, car_type_id, type_label FROM (
  SELECT *, row_number() OVER (PARTITION BY model_series_id ORDER BY year_from, car_type_id) AS rn
  FROM car_types) x WHERE rn <= 3""", ("car_types",))
def w5(t):
    from catalog_lake.operators.ordering import first_n_per
    return first_n_per(t.car_types, ["model_series_id"], ["year_from", "car_type_id"], 3) \
        .select("model_series_id", "car_type_id", "type_label")


@register("w8_drop_full_duplicates", "SELECT DISTINCT * FROM compatible_cars", (C,))
def w8(t):
    return dd.drop_full_duplicates(t.compatible_cars, t.compatible_cars.columns)


# -- upserts -------------------------------------------------------------------
def _target(t):
    return t.articles.select("article_id", F.concat("part_name", F.lit(" (r1)")).alias("part_name"),
                             "part_number", "is_oem")


def _source(t):
    a = t.articles
    r2 = a.filter(F.col("article_id") % 3 == 0).select(
        "article_id", F.concat("part_name", F.lit(" (r2)")).alias("part_name"), "part_number", "is_oem")
    r2b = a.filter(F.col("article_id") % 6 == 0).select(
        "article_id", F.concat("part_name", F.lit(" (r2b)")).alias("part_name"), "part_number", "is_oem")
    new = a.filter(F.col("article_id") % 7 == 0).select(
        (F.col("article_id") + 1000000000).alias("article_id"),
        F.concat("part_name", F.lit(" (new)")).alias("part_name"), "part_number", "is_oem")
    nullkey = a.filter(F.col("article_id") % 11 == 0).select(
        F.lit(None).cast("bigint").alias("article_id"), F.lit("no key").alias("part_name"), "part_number", "is_oem")
    return r2.unionByName(r2b).unionByName(new).unionByName(nullkey)


_UPSERT_CTE = """
WITH target AS (SELECT article_id, concat(part_name, ' (r1)') AS part_name, part_number, is_oem FROM articles),
source AS (SELECT article_id, concat(part_name, ' (r2)') AS part_name, part_number, is_oem FROM articles
           WHERE article_id % 3 = 0
           UNION ALL SELECT article_id, concat(part_name, ' (r2b)'), part_number, is_oem FROM articles
           WHERE article_id % 6 = 0
           UNION ALL SELECT article_id + 1000000000, concat(part_name, ' (new)'), part_number, is_oem
           FROM articles WHERE article_id % 7 = 0
           UNION ALL SELECT NULL, 'no key', part_number, is_oem FROM articles WHERE article_id % 11 = 0),
src1 AS (SELECT article_id, part_name, part_number, is_oem FROM (
           SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY part_name, part_number, is_oem) AS rn
           FROM source WHERE article_id IS NOT NULL) x WHERE rn = 1)
"""
_UPSERT = _UPSERT_CTE + """
SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM src1 s WHERE s.article_id = t.article_id)
UNION ALL SELECT * FROM src1"""


@register("k1_w7_f13_upsert", _UPSERT, (A,))
def k1(t):
    return up.upsert(_target(t), _source(t), "article_id")


@register("k8_upsert_idempotent", _UPSERT, (A,))
def k8(t):
    """Applying the same batch twice equals applying it once."""
    s = _source(t)
    return up.upsert(up.upsert(_target(t), s, "article_id"), s, "article_id")


@register("k1_upsert_by_key_range", """
SELECT o_orderkey, CASE WHEN o_orderkey <= 300 OR o_orderkey % 5000 = 7 THEN -1 ELSE o_custkey END AS o_custkey FROM orders
UNION ALL SELECT -1, -1""")
def k1_ranges(t):
    """A table of files by key range, then a batch of the first keys, a few scattered ones and one below all."""
    orders = t.table("orders").select(F.col("o_orderkey").cast("bigint"), F.col("o_custkey").cast("bigint"))
    table = KeyedTable(t.spark, scratch(t.spark, "keyed"), "o_orderkey", "o_orderkey bigint, o_custkey bigint", rows_per_file=1000)
    table.overwrite(orders)
    batch = orders.filter("o_orderkey <= 300 OR o_orderkey % 5000 = 7").select("o_orderkey", F.lit(-1).cast("bigint").alias("o_custkey"))
    table.upsert(batch.unionByName(t.spark.range(1).selectExpr("-1L AS o_orderkey", "-1L AS o_custkey")))
    return table.read()


@register("k4_children_by_key_range", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey > 500
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey <= 500 AND l_orderkey % 2 = 0 AND l_linenumber = 1""")
def k4_ranges(t):
    """Lines by order: the orders up to 500 are loaded again, the even ones with one line, the odd ones with none."""
    lines = t.table("lineitem").select(F.col("l_orderkey").cast("bigint"), "l_linenumber", "l_partkey")
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in lines.schema.fields)
    table = KeyedTable(t.spark, scratch(t.spark, "keyed"), "l_orderkey", ddl, rows_per_file=5000)
    table.overwrite(lines)
    table.merge(lines.filter("l_orderkey <= 500 AND l_orderkey % 2 = 0 AND l_linenumber = 1"), lines.filter("l_orderkey <= 500").select("l_orderkey"))
    return table.read()


@register("t2_deep_pages", """
WITH r AS (SELECT article_id, part_name, row_number() OVER (ORDER BY part_name, article_id) AS position, count(*) OVER () AS n FROM articles)
SELECT article_id, part_name, position FROM r
WHERE position <= 20 OR (position - 1) // 20 = (n // 2) // 20 OR (position - 1) // 20 = (n - 1) // 20""", (A,))
def t2_deep(t):
    """The first, the middle and the last page of all articles by name."""
    pages = SortedPages.build(t.articles.select("article_id", "part_name"), ["part_name", "article_id"], f"{scratch(t.spark, 'pages')}/p")
    numbers = sorted({1, (pages.total // 2) // 20 + 1, max(pages.total - 1, 0) // 20 + 1})
    return reduce(DataFrame.unionByName, [pages.page(k, 20) for k in numbers])


@register("i8_split_plan", """
WITH plan AS (SELECT article_id, image_index, url FROM (
        SELECT *, row_number() OVER (PARTITION BY article_id, url ORDER BY image_index) AS rn FROM (
          SELECT article_id, unnest(image_urls) AS url, unnest(range(1, len(image_urls) + 1)) AS image_index
          FROM article_details) e WHERE url <> '') x WHERE rn = 1)
SELECT article_id, image_index, url, image_index % 3 = 1 AND article_id % 2 = 0 AS fetched FROM plan""", (D,))
def i8_split(t):
    """The image plan against a manifest: even articles fetched or cached some images, odd ones failed."""
    plan = inc.image_plan(t.article_details).select("article_id", "image_index", "url")
    status = F.when(F.col("article_id") % 2 == 1, "error").when(F.col("article_id") % 4 == 0, "cached").otherwise("downloaded")
    done, todo = inc.split_plan(plan, plan.filter("image_index % 3 = 1").select("article_id", "url", status.alias("status")))
    return done.withColumn("fetched", F.lit(True)).unionByName(todo.withColumn("fetched", F.lit(False)))


@register("k2_insert_missing", _UPSERT_CTE + """
SELECT * FROM target
UNION ALL SELECT * FROM source s WHERE s.article_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM target t WHERE t.article_id = s.article_id)""", (A,))
def k2(t):
    src = _source(t).filter(F.col("article_id").isNotNull())
    return up.insert_missing(_target(t), src, "article_id")


@register("k4_replace_children", """
WITH incoming AS (SELECT article_id, car_type_id, model_series_id, manufacturer_name, model_name,
                         engine_or_variant, year_from, year_to, 'replaced' AS extra_qualifier
                  FROM compatible_cars WHERE article_id % 5 = 0 AND engine_or_variant = 'N')
SELECT * FROM compatible_cars c WHERE c.article_id NOT IN (SELECT article_id FROM incoming)
UNION ALL SELECT * FROM incoming""", (C,))
def k4(t):
    c = t.compatible_cars
    inc_rows = c.filter((F.col("article_id") % 5 == 0) & (F.col("engine_or_variant") == "N")) \
        .withColumn("extra_qualifier", F.lit("replaced"))
    return up.replace_children(c, inc_rows, "article_id")


@register("k4_parents_without_children", """
SELECT * FROM compatible_cars c WHERE c.article_id % 5 <> 0""", (C,))
def k4_parents(t):
    """Loaded parents whose new list is empty lose their old children."""
    c = t.compatible_cars
    return up.replace_children(c, c.limit(0), "article_id", t.articles.filter(F.col("article_id") % 5 == 0))


@register("k3_explode_compat", """
SELECT article_id, car_type_id, model_series_id, manufacturer_name, model_name, engine_or_variant,
       year_from, year_to, '' AS extra_qualifier FROM compatible_cars
UNION ALL
SELECT article_id, NULL, NULL, manufacturer_name, '', '', '', '', '' FROM compatible_cars
WHERE engine_or_variant = 'R'""", (C,))
def k3(t):
    """Nested detail records (ids as text, some fields missing) exploded back to typed rows."""
    c = t.compatible_cars
    s = lambda x: F.col(x).cast("string")
    full = F.struct(s("car_type_id").alias("car_type_id"), s("model_series_id").alias("model_series_id"),
                    F.col("manufacturer_name"), F.col("model_name"), F.col("engine_or_variant"),
                    F.col("year_from"), F.col("year_to"), F.lit(None).cast("string").alias("extra_qualifier"))
    broken = F.struct(F.concat(s("car_type_id"), F.lit("-x")).alias("car_type_id"),
                      F.lit(None).cast("string").alias("model_series_id"), F.col("manufacturer_name"),
                      *[F.lit(None).cast("string").alias(n) for n in
                        ("model_name", "engine_or_variant", "year_from", "year_to", "extra_qualifier")])
    nested = c.select("article_id", F.when(F.col("engine_or_variant") == "R", F.array(full, broken))
                      .otherwise(F.array(full)).alias("compatible_cars"))
    return up.explode_compat(nested)


@register("k6_latest_status_per_url", """
SELECT url, arg_max(status_code, (timestamp, event_id)) AS status_code,
       arg_max(event_id, (timestamp, event_id)) AS event_id,
       arg_max(error_message, (timestamp, event_id)) AS error_message
FROM fetch_log GROUP BY url""", ("fetch_log",))
def k6(t):
    return up.latest_per_key(t.fetch_log, "url", "timestamp", "event_id") \
        .select("url", "status_code", "event_id", "error_message")


# -- counters ----------------------------------------------------------------
@register("g9_status_counts", "SELECT status_code, count(*) AS n FROM fetch_log GROUP BY status_code",
          ("fetch_log",))
def g9(t):
    return rel.status_counts(t.fetch_log, "status_code")


@register("g10_crawl_counters", """
SELECT 'manufacturers' AS counter, count(*) AS n FROM crawled_mf
UNION ALL SELECT 'models', count(*) FROM crawled_ms
UNION ALL SELECT 'car_types', count(*) FROM crawled_ct
UNION ALL SELECT 'car_types_filtered', (SELECT count(*) FROM car_types) - (SELECT count(*) FROM crawled_ct)
UNION ALL SELECT 'groups', count(*) FROM cat_groups
UNION ALL SELECT 'articles', count(*) FROM articles
UNION ALL SELECT 'articles_oem', count(*) FROM articles WHERE is_oem
UNION ALL SELECT 'article_details', count(*) FROM article_details
UNION ALL SELECT 'details_skipped_no_parent', count(*) FROM article_details d
          WHERE NOT EXISTS (SELECT 1 FROM articles a WHERE a.article_id = d.article_id)
UNION ALL SELECT 'fetch_ok', count(*) FROM fetch_log WHERE status_code = 200
UNION ALL SELECT 'fetch_failed', count(*) FROM fetch_log WHERE status_code <> 200
UNION ALL SELECT 'urls_seen', count(DISTINCT url) FROM fetch_log""",
          ("crawled_mf", "crawled_ms", "crawled_ct", "car_types", "cat_groups", A, D, "fetch_log"))
def g10(t):
    return rd.crawl_counters(t, bf.crawled_dimensions(t))


@register("g15_round_growth", f"""
WITH r AS (SELECT {_RNUM} AS round_no, round_label, pk FROM rounds),
first AS (SELECT pk, min(round_no) AS first_round FROM r GROUP BY pk),
per AS (SELECT r.round_no, r.round_label, count(*) AS rows, count(DISTINCT r.pk) AS keys,
               count(DISTINCT CASE WHEN f.first_round = r.round_no THEN r.pk END) AS new_keys
        FROM r JOIN first f USING (pk) GROUP BY r.round_no, r.round_label)
SELECT round_label, rows, keys, new_keys,
       round(CAST(keys - new_keys AS DOUBLE) * 100.0 / keys, 1) AS pct_seen,
       (CAST(keys - new_keys AS DOUBLE) * 100.0 / keys >= 90.0 AND new_keys < 500) AS stop
FROM per""", ("rounds",))
def g15(t):
    return rd.round_growth(t.rounds, "pk", "round_label")


@register("u3_new_keys_per_round", f"""
WITH r AS (SELECT {_RNUM} AS round_no, round_label, pk FROM rounds)
SELECT DISTINCT r.round_label, r.pk FROM r
WHERE NOT EXISTS (SELECT 1 FROM r e WHERE e.pk = r.pk AND e.round_no < r.round_no)""", ("rounds",))
def u3(t):
    return rd.new_keys_per_round(t.rounds, "pk", "round_label")


@register("u4_union_flagged", "SELECT article_id, part_name, is_oem FROM articles", (A,))
def u4(t):
    a = t.articles.select("article_id", "part_name", "is_oem")
    return rel.union_flagged(a.filter(~F.col("is_oem")).drop("is_oem"), a.filter(F.col("is_oem")).drop("is_oem"))


@register("u2_union_rounds", """
SELECT pk, round_label, row_pos, event_type, NULL AS value FROM rounds WHERE event_type = 'view'
UNION ALL SELECT pk, round_label, row_pos, event_type, value FROM rounds WHERE event_type <> 'view'""",
          ("rounds",))
def u2(t):
    r = t.rounds.select("pk", "round_label", "row_pos", "event_type", "value")
    return rel.union_rounds([r.filter(F.col("event_type") == "view").drop("value"),
                             r.filter(F.col("event_type") != "view")])


@register("j7_details_with_parent", """
SELECT (SELECT count(*) FROM article_details d WHERE EXISTS (
          SELECT 1 FROM articles a WHERE a.article_id = d.article_id)) AS kept,
       (SELECT count(*) FROM article_details d WHERE NOT EXISTS (
          SELECT 1 FROM articles a WHERE a.article_id = d.article_id)) AS skipped""", (A, D))
def j7(t):
    kept, skipped = rel.with_parent(t.article_details, t.articles, "article_id")
    return kept.agg(F.count(F.lit(1)).alias("kept")).crossJoin(skipped)


@register("j13_coverage", """
SELECT (SELECT count(DISTINCT article_id) FROM articles) AS total,
       (SELECT count(DISTINCT article_id) FROM articles WHERE article_id IN (SELECT article_id FROM article_details))
         AS with_details,
       (SELECT count(DISTINCT article_id) FROM articles WHERE article_id IN (SELECT article_id FROM compatible_cars))
         AS with_cars,
       round(CAST((SELECT count(DISTINCT article_id) FROM articles
                   WHERE article_id IN (SELECT article_id FROM article_details)) AS DOUBLE) * 100.0
             / (SELECT count(DISTINCT article_id) FROM articles), 1) AS pct_with_details,
       round(CAST((SELECT count(DISTINCT article_id) FROM articles
                   WHERE article_id IN (SELECT article_id FROM compatible_cars)) AS DOUBLE) * 100.0
             / (SELECT count(DISTINCT article_id) FROM articles), 1) AS pct_with_cars""", (A, D, C))
def j13(t):
    return rel.coverage(t.articles, "article_id", {"details": t.article_details, "cars": t.compatible_cars})


@register("g11_i8_manifest_totals", """
WITH plan AS (SELECT article_id, image_index, url FROM (
        SELECT *, row_number() OVER (PARTITION BY article_id, url ORDER BY image_index) AS rn FROM (
          SELECT article_id, unnest(image_urls) AS url, unnest(range(1, len(image_urls) + 1)) AS image_index
          FROM article_details) e WHERE url <> '') x WHERE rn = 1),
manifest AS (SELECT article_id, image_index, url,
                    CASE WHEN url LIKE '%cdn.example%' THEN 'error' WHEN image_index = 1 THEN 'cached'
                         ELSE 'downloaded' END AS status FROM plan)
SELECT count(*) FILTER (WHERE status = 'downloaded') AS downloaded,
       count(*) FILTER (WHERE status = 'cached') AS cached,
       count(*) FILTER (WHERE status NOT IN ('downloaded', 'cached')) AS errors
FROM manifest""", (D,))
def g11(t):
    plan = inc.image_plan(t.article_details)
    manifest = plan.withColumn("status", F.when(F.col("url").like("%cdn.example%"), F.lit("error"))
                               .when(F.col("image_index") == 1, F.lit("cached")).otherwise(F.lit("downloaded")))
    return inc.manifest_totals(manifest)



@register("a5_a3_w2_rounds_roundtrip", f"""
SELECT pk, arg_max(round_label, {_RNUM}) AS round_label, count(*) AS records
FROM rounds GROUP BY pk""", ("rounds",))
def a5(t):
    """Rounds written Hive-partitioned (entity_type=/crawl_date=), read back recursively with
    file provenance, newest round kept per key."""
    from catalog_lake.session import scratch
    from catalog_lake.sources import rounds as rs
    base = scratch(t.spark, "rounds")
    (t.rounds.select("pk", "round_label", "row_pos", "event_type")
     .withColumn("entity_type", F.lit("events")).withColumn("crawl_date", F.col("round_label"))
     .write.partitionBy("entity_type", "crawl_date").option("compression", "zstd").parquet(base))
    r = rs.read_rounds(t.spark, base, "events")
    counts = r.groupBy("pk").agg(F.count(F.lit(1)).alias("records"))
    return rs.dedup_rounds(r, "pk").select("pk", F.col("crawl_date").alias("round_label")).join(counts, "pk")
