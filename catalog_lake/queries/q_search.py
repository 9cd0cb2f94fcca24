"""Full-text search S1–S6, keyword search Q7, faceted search Q9, total hits G14."""

from pyspark.sql import functions as F

from catalog_lake.operators import search as sx
from catalog_lake.queries.registry import register

V = ("articles", "article_details", "postings")


def _postings(t):
    return t.postings


# The oracles state each query by hand, without the parser under test.
_HAS = "article_id IN (SELECT article_id FROM postings WHERE token = '{}')"
_PAIR = """article_id IN (SELECT a.article_id FROM postings a JOIN postings b
  ON b.article_id = a.article_id AND b.field = a.field AND b.pos = a.pos + 1 WHERE a.token = '{}' AND b.token = '{}')"""


def _where(cond: str, universe: str = "articles") -> str:
    return f"SELECT article_id FROM {universe} WHERE {cond}"


def _rank(*tokens: str) -> str:
    listed = ", ".join(f"'{t}'" for t in tokens)
    return f"""SELECT article_id, sum(weight * CAST(tf AS DOUBLE) / (tf + 1)) AS relevance FROM (
        SELECT article_id, token, field, weight, count(*) AS tf FROM postings WHERE token IN ({listed})
        GROUP BY article_id, token, field, weight) x GROUP BY article_id"""


@register("s1_postings", "SELECT token, article_id, field, weight, pos FROM postings", V)
def s1(t):
    """The index build itself (not the stored copy)."""
    return sx.build_postings(t.articles, t.article_details).select("token", "article_id", "field", "weight", "pos")


_RED, _PLATE = _HAS.format("red"), _HAS.format("plate")
_MATCHES = {
    "s2_match_words": ("red plate", f"{_RED} AND {_PLATE}"),
    "s2_match_phrase": ('"hot plate"', _PAIR.format("hot", "plate")),
    "s2_match_or": ("widget or gear", f"{_HAS.format('widget')} OR {_HAS.format('gear')}"),
    "s2_match_exclude": ("plate -red", f"{_PLATE} AND NOT {_RED}"),
    "s2_match_part_number": ("PN-12", _PAIR.format("pn", "12")),
    "s2_match_brand_or_phrase": ('brand#2 "small ring" or gizmo -blue',
                                 f"({_PAIR.format('brand', '2')} AND {_PAIR.format('small', 'ring')})"
                                 f" OR ({_HAS.format('gizmo')} AND NOT {_HAS.format('blue')})"),
    "s2_or_binds_weaker": ("red plate or ring", f"({_RED} AND {_PLATE}) OR {_HAS.format('ring')}"),
    "s2_or_not": ("widget or -red", f"{_HAS.format('widget')} OR NOT {_RED}"),
    "s2_no_word": ("!!!", "false"),
    "s2_many_words": ('"red plate" or "red ring" or "hot plate" or widget -gear or pn -brand -"small ring"',
                      f"{_PAIR.format('red', 'plate')} OR {_PAIR.format('red', 'ring')} OR {_PAIR.format('hot', 'plate')}"
                      f" OR ({_HAS.format('widget')} AND NOT {_HAS.format('gear')})"
                      f" OR ({_HAS.format('pn')} AND NOT {_HAS.format('brand')} AND NOT {_PAIR.format('small', 'ring')})"),
}


def _reg_match(key: str, q: str, cond: str) -> None:
    @register(key, _where(cond), V)
    def _f(t):
        return sx.match(_postings(t), q, t.articles)


for _k, (_v, _w) in _MATCHES.items():
    _reg_match(_k, _v, _w)


@register("s3_rank", f"""
SELECT m.article_id, round(coalesce(r.relevance, 0.0), 6) AS relevance
FROM ({_where(f"{_RED} AND {_PLATE}")}) m LEFT JOIN ({_rank("red", "plate")}) r USING (article_id)""", V)
def s3(t):
    return sx.with_relevance(t.articles.select("article_id"), _postings(t), "red plate") \
        .select("article_id", F.round("relevance", 6).alias("relevance"))


_Q7_COLS = "a.article_id, a.part_name, a.part_number, a.article_manufacturer, a.group_name, a.thumbnail_url"


@register("q7_keyword_search", f"""
SELECT {_Q7_COLS}, round(coalesce(r.relevance, 0.0), 6) AS relevance
FROM articles a JOIN ({_where(_PLATE)}) m USING (article_id) LEFT JOIN ({_rank("plate")}) r USING (article_id)
ORDER BY relevance DESC, article_id LIMIT 20""", V)
def q7(t):
    return sx.keyword_search(t.articles, _postings(t), "plate", 20) \
        .select("article_id", "part_name", "part_number", "article_manufacturer", "group_name", "thumbnail_url",
                "relevance")


@register("q7_keyword_search_car_filter", f"""
SELECT {_Q7_COLS}, round(coalesce(r.relevance, 0.0), 6) AS relevance
FROM articles a JOIN ({_where(f"{_PLATE} OR {_HAS.format('ring')}")}) m USING (article_id)
     LEFT JOIN ({_rank("plate", "ring")}) r USING (article_id)
WHERE a.article_id IN (SELECT DISTINCT article_id FROM compatible_cars
                       WHERE manufacturer_name ILIKE '%nation_1%' AND model_name ILIKE '%#0000001%')
ORDER BY relevance DESC, article_id LIMIT 20""", V + ("compatible_cars",))
def q7c(t):
    car = sx.car_filter(t.compatible_cars, make="nation_1", model="#0000001")
    return sx.keyword_search(t.articles, _postings(t), "plate or ring", 20, car) \
        .select("article_id", "part_name", "part_number", "article_manufacturer", "group_name", "thumbnail_url",
                "relevance")


_Q9_FILTER = """a.is_oem = true AND a.article_id IN (
    SELECT DISTINCT article_id FROM compatible_cars
    WHERE manufacturer_name ILIKE '%nation_2%' AND (year_from = '' OR CAST(substr(year_from, 1, 4) AS INT) <= 1998)
      AND (year_to = '' OR CAST(substr(year_to, 1, 4) AS INT) >= 1998))"""
_Q9_COLS = "a.article_id, a.part_name, a.part_number, a.article_manufacturer, a.group_name, a.is_oem, " \
           "a.thumbnail_url, a.details_url"


@register("q9_s4_f14_faceted_search", f"""
WITH f AS (SELECT * FROM articles a WHERE {_Q9_FILTER}),
m AS (SELECT f.* FROM f WHERE f.article_id IN ({_where(f"{_PLATE} OR {_HAS.format('widget')}", "f")})),
total AS (SELECT count(*) AS total FROM m)
SELECT {_Q9_COLS}, round(coalesce(r.relevance, 0.0), 6) AS relevance, total.total
FROM m a LEFT JOIN ({_rank("plate", "widget")}) r USING (article_id), total
ORDER BY relevance DESC, article_id LIMIT 10 OFFSET 10""", V + ("compatible_cars",))
def q9(t):
    rows, total = sx.search(t.articles, _postings(t), t.compatible_cars, q="plate or widget", make="nation_2",
                            year="1998", is_oem=True, page=2, limit=10)
    return rows.select("article_id", "part_name", "part_number", "article_manufacturer", "group_name", "is_oem",
                       "thumbnail_url", "details_url", "relevance").crossJoin(total)


@register("q9_f15_with_article_numbers", f"""
WITH m AS (SELECT a.article_id, a.part_name, round(coalesce(r.relevance, 0.0), 6) AS relevance
           FROM articles a JOIN ({_where(f"{_PLATE} AND NOT {_RED}")}) m USING (article_id) LEFT JOIN ({_rank("plate")}) r USING (article_id)
           ORDER BY relevance DESC, a.article_id LIMIT 100)
SELECT m.article_id, part_name, relevance, article_number FROM m LEFT JOIN article_details d USING (article_id)""", V + ("compatible_cars",))
def q9n(t):
    rows, _ = sx.search(t.articles, _postings(t), t.compatible_cars, q="plate -red", limit=100)
    return sx.with_numbers(rows.select("article_id", "part_name", "relevance"), t.article_details)


@register("q9_t4_search_without_text", f"""
SELECT {_Q9_COLS}, CAST(NULL AS DOUBLE) AS relevance,
       (SELECT count(*) FROM articles WHERE NOT is_oem) AS total
FROM articles a WHERE NOT a.is_oem ORDER BY a.article_id LIMIT 20 OFFSET 40""", V)
def q9b(t):
    rows, total = sx.search(t.articles, lambda: _postings(t), lambda: t.compatible_cars, q="", is_oem=False, page=3, limit=20)
    return rows.select("article_id", "part_name", "part_number", "article_manufacturer", "group_name", "is_oem",
                       "thumbnail_url", "details_url", "relevance").crossJoin(total)


@register("g14_total_hits", f"""
SELECT count(*) AS total FROM articles a
WHERE a.article_id IN ({_where(_PLATE)}) AND a.article_id IN (
  SELECT article_id FROM compatible_cars WHERE model_name ILIKE '%customer#00000%')""", V + ("compatible_cars",))
def g14(t):
    _, total = sx.search(t.articles, _postings(t), t.compatible_cars, q="plate", model="customer#00000")
    return total


@register("s5_index_health", """
SELECT (SELECT count(*) FROM articles) AS articles,
       (SELECT count(*) FROM articles WHERE article_id IN (SELECT article_id FROM postings))
         AS articles_with_search_vector""", V)
def s5(t):
    return sx.index_health(t.articles, _postings(t))


@register("s6_contains_manufacturer", """
SELECT article_id, part_name, article_manufacturer FROM articles WHERE article_manufacturer ILIKE '%brand#1%'""",
          ("articles",))
def s6(t):
    return sx.contains_search(t.articles, "article_id", "article_manufacturer", "brand#1") \
        .select("article_id", "part_name", "article_manufacturer")


@register("s6_contains_trigram_prefilter", """
SELECT article_id, part_number FROM articles WHERE part_number ILIKE '%-123%'""", ("articles",))
def s6t(t):
    return sx.contains_search(t.articles, "article_id", "part_number", "-123", t.grams.filter("field = 'part_number'")) \
        .select("article_id", "part_number")


@register("s6_contains_name_grams", """
SELECT article_id, part_name FROM articles WHERE part_name ILIKE '%d pla%'""", ("articles",))
def s6n(t):
    return sx.contains_search(t.articles, "article_id", "part_name", "D PLA", t.grams.filter("field = 'part_name'")) \
        .select("article_id", "part_name")


@register("s6_gram_counts", """
SELECT field, gram, count(*) AS articles FROM (
  SELECT DISTINCT article_id, field, substr(v, i, 3) AS gram FROM (
    SELECT article_id, 'part_number' AS field, lower(part_number) AS v, unnest(range(1, length(part_number) - 1)) AS i FROM articles
    UNION ALL
    SELECT article_id, 'part_name', lower(part_name), unnest(range(1, length(part_name) - 1)) FROM articles
    UNION ALL
    SELECT article_id, 'article_manufacturer', lower(article_manufacturer), unnest(range(1, length(article_manufacturer) - 1)) FROM articles) x) y
GROUP BY field, gram""", ("articles",))
def s6g(t):
    """The stored index itself."""
    return t.grams.groupBy("field", "gram").agg(F.count(F.lit(1)).alias("articles"))
