"""Sources and sinks A1-A15 as round trips: write the bound tables, read them back, compare with the view."""

from pyspark.sql import functions as F

from catalog_lake.queries.registry import register
from catalog_lake.session import scratch
from catalog_lake.sources import files
from catalog_lake.sources import rounds as rs

A = ("articles",)
_COLS = ["article_id", "part_name", "part_number", "article_manufacturer"]
_SELECT = "SELECT article_id, part_name, part_number, article_manufacturer FROM articles"


@register("a1_a2_d8_read_json_ids", _SELECT, A)
def a1(t):
    """Ids written as numbers, as numbers with a fraction part, and as quoted text all read as the same id."""
    base = scratch(t.spark, "json")
    rows = t.articles.select(*_COLS)
    kinds = {"bigint": 0, "double": 1, "string": 2}
    for kind, k in kinds.items():
        rs.append_entity(rows.filter(F.col("article_id") % 3 == k).withColumn("article_id", F.col("article_id").cast(kind)),
                         base, "articles")
    return rs.read_entity(t.spark, f"{base}/articles", "articles").select(*_COLS)


@register("a5_a7_rewritten_round", _SELECT, A)
def a5_a7(t):
    """A round that is written twice, in small files, holds each record once."""
    base = scratch(t.spark, "rounds")
    for _ in range(2):
        rs.write_round(t.articles.select(*_COLS), base, "articles", "r1", max_records=1000)
    rs.write_round(t.articles.select(*_COLS).limit(0), base, "articles", "r2")
    return rs.read_rounds(t.spark, base, "articles").select(*_COLS)


@register("a6_a9_convert_with_bad_lines", f"""
SELECT 'articles' AS entity, 'converted' AS status, count(*) AS "rows",
       count(*) FILTER (WHERE article_id % 7 = 0) AS bad_lines FROM ({_SELECT}) a""", A)
def a6(t):
    """Conversion counts the lines that are no JSON and keeps the others."""
    base = scratch(t.spark, "store")
    rs.append_entity(t.articles.select(*_COLS), f"{base}/in", "articles")
    t.articles.filter(F.col("article_id") % 7 == 0).select(F.concat(F.lit("{cut off "), "part_name").alias("value")) \
        .write.mode("append").text(f"{base}/in/articles")
    return rs.convert_all(t.spark, f"{base}/in", f"{base}/out", "2026-01-01", entities=["articles"])


@register("a8_a13_a14_snapshot_published", _SELECT, A)
def a8(t):
    """Two versions of a snapshot; the published one is read back."""
    base = scratch(t.spark, "lake")
    rs.publish(t.spark, rs.write_snapshot(t.articles.select(*_COLS).filter("article_id % 2 = 0"), base, "articles"))
    rs.publish(t.spark, rs.write_snapshot(t.articles.select(*_COLS), base, "articles"))
    return rs.current(t.spark, base, "articles")


@register("a4_a14_load_with_skip_report", """
SELECT 'articles' AS entity, 'loaded' AS status, (SELECT count(*) FROM articles) AS "rows", 0 AS skipped, 3 AS skipped_files,
       (SELECT count(*) FROM articles WHERE article_id % 50 = 0) AS keyless
UNION ALL SELECT 'article_details', 'loaded', count(*) FILTER (WHERE article_id IN (SELECT article_id FROM articles)),
       count(*) FILTER (WHERE article_id NOT IN (SELECT article_id FROM articles)), 0, 0 FROM article_details
UNION ALL SELECT e, 'missing', 0, 0, 0, 0 FROM (VALUES ('manufacturers'), ('models'), ('car_types'), ('car_type_details'), ('category_groups')) v(e)""",
          ("articles", "article_details"))
def a4_a14(t):
    """Two rounds loaded in dependency order: a part of the articles without a key, and among their files two of no
    bytes and one of garbage, which the report counts from the load's own scan."""
    from catalog_lake.plans.load import load_rounds
    base = scratch(t.spark, "load")
    articles = t.articles.select(*_COLS)
    rs.write_round(articles.filter("article_id % 2 = 0"), f"{base}/rounds", "articles", "r1", max_records=500)
    keyless = articles.filter("article_id % 50 = 0").withColumn("article_id", F.lit(None).cast("bigint"))
    rs.write_round(articles.unionByName(keyless), f"{base}/rounds", "articles", "r2", max_records=500)
    rs.write_round(t.article_details.select("article_id", "article_name", "article_number"), f"{base}/rounds", "article_details", "r1")
    for name, data in (("a.parquet", b""), ("b.parquet", b""), ("c.parquet", b"PAR1 is not all it takes PAR2")):
        fs, path, _ = rs._fs(t.spark, f"{base}/rounds/entity_type=articles/crawl_date=r2/{name}")
        out = fs.create(path, True)
        out.write(bytearray(data))
        out.close()
    return load_rounds(t.spark, f"{base}/rounds", f"{base}/lake").select(
        "entity", "status", "rows", "skipped", F.col("skipped_files").cast("int"), "keyless")


@register("a14_load_all_snapshots", """
SELECT 'articles' AS entity, 'loaded' AS status, count(*) AS "rows" FROM articles
UNION ALL SELECT 'article_details', 'loaded', count(*) FROM article_details
UNION ALL SELECT 'manufacturers', 'loaded', count(*) FROM manufacturers
UNION ALL SELECT e, 'missing', 0 FROM (VALUES ('models'), ('car_types'), ('car_type_details'), ('category_groups')) v(e)""",
          ("articles", "article_details", "manufacturers"))
def a14(t):
    """Published snapshots loaded in dependency order into tables; what was never published is named."""
    base = scratch(t.spark, "lake")
    for entity, rows in (("articles", t.articles.select(*_COLS)), ("manufacturers", t.manufacturers),
                         ("article_details", t.article_details.select("article_id", "article_name"))):
        rs.publish(t.spark, rs.write_snapshot(rows, base, entity))

    def load(entity, df):
        df.write.parquet(f"{base}/target/{entity}")
        return t.spark.read.parquet(f"{base}/target/{entity}").count()
    return rs.load_all(t.spark, base, load)


@register("a10_stored_pages", "SELECT page_id, url, length(html) AS chars FROM pages")
def a10(t):
    path = f"{scratch(t.spark, 'pages')}/stored"
    t.table("pages").withColumn("fetched", F.lit("today")).write.parquet(path)
    return files.read_pages(t.spark, path).select("page_id", "url", F.length("html").cast("bigint").alias("chars"))


@register("a11_allowlist_file", "SELECT manufacturer_name AS name FROM manufacturers", ("manufacturers",))
def a11(t):
    """Names in a text file, among blank lines and comments."""
    path = f"{scratch(t.spark, 'allow')}/names"
    t.manufacturers.select(F.concat(F.lit("# next\n\n  "), "manufacturer_name", F.lit(" ")).alias("value")).coalesce(1).write.text(path)
    return files.read_allowlist(t.spark, f"{path}/*.txt").select("name")


@register("a15_blank_lines", _SELECT, A)
def a15(t):
    """Blank lines between the records of a store are no records."""
    base = scratch(t.spark, "blank")
    t.articles.select(F.concat(F.lit("\n"), F.to_json(F.struct(*_COLS)), F.lit("\n  ")).alias("value")).write.text(f"{base}/articles")
    return rs.read_entity(t.spark, f"{base}/articles", "articles").select(*_COLS)


@register("a16_manifest_appended", """
SELECT article_id, concat('u', article_id) AS url, CASE WHEN article_id % 2 = 0 THEN 'downloaded' ELSE 'error' END AS status FROM articles
UNION ALL SELECT article_id, concat('u', article_id), 'cached' FROM articles WHERE article_id % 2 = 1""", A)
def a16(t):
    """A second run appends the images that the first one missed."""
    path = f"{scratch(t.spark, 'manifest')}/m"
    rows = t.articles.select("article_id", F.concat(F.lit("u"), "article_id").alias("url"))
    files.append_manifest(rows.withColumn("status", F.when(F.col("article_id") % 2 == 0, "downloaded").otherwise("error")), path)
    files.append_manifest(rows.filter("article_id % 2 = 1").withColumn("status", F.lit("cached")), path)
    return t.spark.read.schema("article_id bigint, url string, status string").json(path)


@register("d29_round_labels_as_text", "SELECT article_id, CASE WHEN article_id % 2 = 0 THEN '20240101' ELSE '2024-01-02' END AS crawl_date FROM articles", A)
def d29(t):
    """Round labels that look like numbers and ones that do not come back as text."""
    base = scratch(t.spark, "labels")
    for k, label in enumerate(("20240101", "2024-01-02")):
        rs.write_round(t.articles.select(*_COLS).filter(F.col("article_id") % 2 == k), base, "articles", label)
    return rs.read_rounds(t.spark, base, "articles").select("article_id", "crawl_date")
