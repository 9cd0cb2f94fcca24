"""What a query binds and shuffles: tables it does not read are not built, rows are not moved for a layout."""

from catalog_lake.binding import Catalog
from catalog_lake.operators import search as sx
from catalog_lake.plans import backfill as bf
from catalog_lake.plans import quality as dq
from catalog_lake.streaming import incremental as inc
from pyspark.sql import functions as F


class Only:
    """A catalogue that has a few tables."""

    def __init__(self, **tables):
        self.__dict__.update(tables)


def test_duplicates_bind_their_table_only(spark):
    articles = spark.createDataFrame([(1,), (1,), (2,)], "article_id long")
    found = dq.duplicate_keys(Only(articles=articles), entities=["articles"])
    assert [tuple(r) for r in found["articles"].collect()] == [(1, 2)]


def test_search_without_text_or_car_binds_no_index(spark):
    def never():
        raise AssertionError("bound")
    articles = spark.createDataFrame([(1, True), (2, False), (3, False)], "article_id long, is_oem boolean")
    rows, total = sx.search(articles, never, never, is_oem=False)
    assert [r["article_id"] for r in rows.collect()] == [2, 3] and total.first()[0] == 2


def test_lines_are_shuffled_once(cat):
    """The compat rows come from one join of the lines; the small tables are joined before."""
    lazy = Catalog(cat.spark, cat.sf_dir, materialize=False)
    threshold = cat.spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        cat.spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = lazy.compatible_cars._jdf.queryExecution().executedPlan().toString()
    finally:
        cat.spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plan.count("Exchange hashpartitioning(l_orderkey") == 1
    top = [line for line in plan.splitlines() if "SortMergeJoin" in line][0]
    assert "l_orderkey" in top and "o_orderkey" in top


def test_missing_car_types_take_the_least_series(spark):
    compat = spark.createDataFrame([(1, 5, "m", "n"), (1, 4, "m", "n"), (1, None, "m", "n"), (2, None, "m", "n"), (3, 7, "m", "n"), (None, 9, "m", "n")],
                                   "car_type_id long, model_series_id long, manufacturer_name string, model_name string")
    mf = spark.createDataFrame([(1, "m")], "manufacturer_id long, manufacturer_name string")
    ms = spark.createDataFrame([(4, 1)], "model_series_id long, manufacturer_id long")
    ct = spark.createDataFrame([(3, 70)], "car_type_id long, model_series_id long")
    got = bf.backfill_dimensions(mf, ms, ct, compat)["car_types"]
    assert sorted(got.collect(), key=lambda r: r[0]) == [(1, 4), (2, None), (3, 70)]
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()


def test_a_session_reads_links_and_log_once(spark):
    links = spark.createDataFrame([("n1",), ("l1",), ("l 2",), ("l3",), ("x",), (None,), ("n1",)], "url string")
    log = spark.createDataFrame([("l1", "1", 1, 200), ("l2", "1", 1, 200), ("l2", "2", 2, 500), ("n1", "1", 1, 200)],
                                "url string, timestamp string, event_id int, status_code int")
    nav = F.when(F.col("url") != "x", F.col("url").startswith("n"))
    got = inc.plan_session(links, log, nav)
    assert sorted(map(tuple, got.collect())) == [("l2", False), ("l3", False), ("n1", True)]
    assert "Union" not in got._jdf.queryExecution().executedPlan().toString()
