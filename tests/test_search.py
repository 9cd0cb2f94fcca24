"""Search in one scan of the postings, against a Python model; the stored indexes' plans."""

import random
import re

import pytest
from pyspark.sql import functions as F

from catalog_lake.operators import search as sx

WEIGHT = {"part_name": 1.0, "part_number": 0.4, "article_number": 0.4, "article_manufacturer": 0.2}


def tokens(text):
    return re.split(r"[\W_]+", text.lower()) if text else [""]


def has(doc, phrase):
    return any(t[i:i + len(phrase)] == phrase for t in doc.values() for i in range(len(t)))


def expected(docs, alternatives):
    """Relevance of the matching articles: alternatives of (excluded, phrase)."""
    out = {}
    words = {w for alt in alternatives for excluded, p in alt if not excluded for w in p}
    for key, doc in docs.items():
        if any(all(has(doc, p) != excluded for excluded, p in alt) for alt in alternatives):
            tf = [(WEIGHT[f], t.count(w)) for f, t in doc.items() for w in words]
            out[key] = round(sum(weight * n / (n + 1) for weight, n in tf), 6)
    return out


@pytest.fixture(scope="module")
def shop(spark):
    rnd, words = random.Random(2), ["red", "hot", "plate", "ring", "gear", "12"]
    rows = [(k, " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 5))), f"{rnd.choice(words)}-{k % 7}", rnd.choice([None, "", "Ring Co", "hot"]),
             rnd.choice([None, "12 hot", "x"])) for k in range(300)]
    articles = spark.createDataFrame([r[:4] for r in rows], "article_id long, part_name string, part_number string, article_manufacturer string")
    details = spark.createDataFrame([(r[0], r[4]) for r in rows if r[0] % 5], "article_id long, article_number string")
    docs = {r[0]: {"part_name": tokens(r[1]), "part_number": tokens(r[2]), "article_manufacturer": tokens(r[3]),
                   "article_number": tokens(r[4] if r[0] % 5 else None)} for r in rows}
    return articles, sx.build_postings(articles, details).persist(), docs


def test_against_the_model(spark, shop):
    articles, postings, docs = shop
    rnd, words = random.Random(4), ["red", "hot", "plate", "ring", "gear", "12", "none"]
    for _ in range(25):
        alternatives = [[(rnd.random() < 0.3, [rnd.choice(words) for _ in range(rnd.choice((1, 1, 2, 3)))]) for _ in range(rnd.randint(1, 3))]
                        for _ in range(rnd.randint(1, 3))]
        q = " or ".join(" ".join(f'{"-" * excluded}"{" ".join(p)}"' for excluded, p in alt) for alt in alternatives)
        got = {r["article_id"]: round(r["relevance"], 6) for r in sx.with_relevance(articles.select("article_id"), postings, q).collect()}
        assert got == expected(docs, alternatives), q
        assert {r["article_id"] for r in sx.match(postings, q, articles).collect()} == set(got)


def test_only_the_given_articles(spark, shop):
    articles, postings, docs = shop
    some = articles.filter("article_id < 40")
    assert {r["article_id"] for r in sx.match(postings, "-red", some).collect()} == {k for k in range(40) if not has(docs[k], ["red"])}
    assert sx.match(postings, "", some).count() == sx.match(postings, '"" - or', some).count() == 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_postings_scan_for_any_number_of_words(cat):
    for q in ("red", "red plate ring", 'red "hot plate" or gear -widget or "small ring" -"red plate"'):
        plan = _plan(sx.keyword_search(cat.articles, cat.postings, q))
        assert len(re.findall(r"FileScan parquet \[token", plan)) == 1
        assert re.search(r"PushedFilters: \[(In|IsNotNull)\(token", plan)


def test_gram_index_is_read_by_range(spark, cat):
    found = sx.contains_search(cat.articles, "article_id", "part_number", "-123", cat.grams.filter("field = 'part_number'"))
    plan = _plan(found)
    assert re.search(r"PushedFilters: \[[^\]]*In\(gram, \[-12,123\]\)", plan)
    # A gram's rows are in the files that its range covers: those ranges do not overlap.
    ranges = sorted(tuple(r) for r in cat.grams.groupBy(F.input_file_name()).agg(F.min("gram").alias("a"), F.max("gram").alias("b")).select("a", "b").collect())
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:], strict=False))


def test_contains_search_is_exact(spark):
    rows = [(1, "ABC-123"), (2, "abc"), (3, "ab"), (4, None), (5, "xabcx 12"), (6, "a%c"), (7, "ABx bc-1")]
    df = spark.createDataFrame(rows, "article_id long, v string")
    grams = sx.build_grams(df, "article_id", ("v",))
    for x in ("abc", "BC-1", "a", "a%c", "%c", "c x", "123", "abc_1", "b_-1"):
        like = re.compile("".join(".*" if c == "%" else "." if c == "_" else re.escape(c) for c in x), re.IGNORECASE | re.DOTALL)
        want = {k for k, v in rows if v is not None and like.search(v)}
        assert {r["article_id"] for r in sx.contains_search(df, "article_id", "v", x, grams).collect()} == want
