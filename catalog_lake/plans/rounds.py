"""Round bookkeeping: growth per round, new keys, crawl counters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog_lake.functions.text import pct, round_number
from catalog_lake.operators import relational as rel

# Fixed values that must equal the reference's stop rule.
STOP_SEEN_PCT = 90.0
STOP_NEW_KEYS = 500


def _with_round_no(rounds: DataFrame, round_col: str) -> DataFrame:
    return rounds.withColumn("_round_no", round_number(round_col))


def new_keys_per_round(rounds: DataFrame, pk: str, round_col: str = "round_label") -> DataFrame:
    """(round, key) for keys never seen in an earlier round.

    First-round per key is a partial aggregate (map-side min), joined back on
    the key; no per-round driver loop, no ``NOT IN`` list.
    """
    r = _with_round_no(rounds, round_col).select(round_col, "_round_no", pk)
    first = r.groupBy(pk).agg(F.min("_round_no").alias("_first"))
    return (r.join(first, pk).filter(F.col("_round_no") == F.col("_first"))
            .select(round_col, pk).distinct())


def round_growth(rounds: DataFrame, pk: str, round_col: str = "round_label") -> DataFrame:
    """Per round rows, keys, new keys, share already seen, and the stop rule."""
    r = _with_round_no(rounds, round_col)
    first = r.groupBy(pk).agg(F.min("_round_no").alias("_first"))
    per = (r.join(first, pk)
           .groupBy("_round_no", round_col)
           .agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(pk).alias("keys"),
                F.countDistinct(F.when(F.col("_first") == F.col("_round_no"), F.col(pk))).alias("new_keys")))
    seen = pct(F.col("keys") - F.col("new_keys"), F.col("keys"))
    raw = (F.col("keys") - F.col("new_keys")).cast("double") * 100.0 / F.col("keys")
    return per.select(round_col, "rows", "keys", "new_keys", seen.alias("pct_seen"),
                      ((raw >= STOP_SEEN_PCT) & (F.col("new_keys") < STOP_NEW_KEYS)).alias("stop"))


def crawl_counters(t, crawled: dict[str, DataFrame]) -> DataFrame:
    """The crawl's twelve counters as labelled rows (one aggregate per input)."""
    ct_all = t.car_types.agg(F.count(F.lit(1)).alias("a"))
    ct_kept = crawled["car_types"].agg(F.count(F.lit(1)).alias("k"))
    filtered = ct_all.crossJoin(ct_kept).select(F.lit("car_types_filtered").alias("counter"),
                                                (F.col("a") - F.col("k")).alias("n"))
    log = t.fetch_log.agg(F.count_if(F.col("status_code") == 200).cast("bigint").alias("ok"),
                          F.count_if(F.col("status_code") != 200).cast("bigint").alias("failed"),
                          F.countDistinct("url").alias("urls"))
    log_rows = log.select(F.explode(F.array(
        F.struct(F.lit("fetch_ok").alias("counter"), F.col("ok").alias("n")),
        F.struct(F.lit("fetch_failed").alias("counter"), F.col("failed").alias("n")),
        F.struct(F.lit("urls_seen").alias("counter"), F.col("urls").alias("n")))).alias("r")).select("r.*")
    counts = rel.label_counts({
        "manufacturers": crawled["manufacturers"], "models": crawled["model_series"],
        "car_types": crawled["car_types"], "groups": t.groups, "articles": t.articles,
        "articles_oem": t.articles.filter("is_oem"), "article_details": t.article_details,
        "details_skipped_no_parent": rel.orphans(t.article_details, t.articles, "article_id"),
    }, "counter")
    return counts.unionByName(filtered).unionByName(log_rows)


def car_type_groups(category_groups: DataFrame) -> DataFrame:
    """Quirk 14: the (car type, group) bridge, taken from the extracted category rows
    *before* groups are de-duplicated by ``group_id`` (which would drop it)."""
    return (category_groups.filter(F.col("car_type_id").isNotNull() & F.col("group_id").isNotNull())
            .select("car_type_id", "group_id").distinct())
