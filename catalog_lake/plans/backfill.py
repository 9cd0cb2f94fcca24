"""Dimension backfill.

Navigation only reaches car types that pass the end-year gate, while
compatibility rows list every vehicle.  The backfill makes every id used by
compat rows resolvable: missing manufacturers get new ids after the current
maximum, missing model series and car types are inserted with null specs,
and null manufacturer links are repaired.  Every step is an anti/semi join
or a keyed keep-one over a pre-aggregated (distinct) projection of compat,
so compat is scanned a few times and never collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog_lake.functions.filters import MIN_YEAR_TO, effective_year_to
from catalog_lake.operators import relational as rel
from catalog_lake.operators.dedup import assign_ids, keep_one
from catalog_lake.operators.upsert import fill_nulls_from, insert_missing


def crawled_dimensions(t, min_year: int = MIN_YEAR_TO) -> dict[str, DataFrame]:
    """What a gated crawl would have produced from the bound catalogue.

    Every tenth crawled model series lost its manufacturer link (as rows
    loaded before their manufacturer do), and every fourth make is listed
    under a different spelling than compat rows use (``NATION 4`` vs
    ``NATION_4``, like ``VOLKSWAGEN`` vs ``VW``).
    """
    ct = effective_year_to(t.car_types, t.car_type_details, min_year)
    ms = (t.model_series.join(ct.select("model_series_id"), "model_series_id", "left_semi")
          .withColumn("manufacturer_id", F.when(F.col("model_series_id") % 10 == 0, F.lit(None))
                      .otherwise(F.col("manufacturer_id"))))
    mf = (t.manufacturers.join(ms.select("manufacturer_id"), "manufacturer_id", "left_semi")
          .withColumn("manufacturer_name", F.when(F.col("manufacturer_id") % 4 == 0,
                                                  F.replace("manufacturer_name", F.lit("_"), F.lit(" ")))
                      .otherwise(F.col("manufacturer_name"))))
    return {"manufacturers": mf, "model_series": ms, "car_types": ct}


def backfill_dimensions(mf: DataFrame, ms: DataFrame, ct: DataFrame, compat: DataFrame) -> dict[str, DataFrame]:
    """K7: steps 2–5 of the dimension repair; returns the three repaired tables."""
    names = compat.select("manufacturer_name").distinct()
    # Step 2: new manufacturers, ids after the current maximum (a one-row frame, not a driver value).
    base = mf.agg(rel.max_id(mf, "manufacturer_id").cast("bigint").alias("base"))
    missing = names.join(mf.select(F.col("manufacturer_name")), "manufacturer_name", "left_anti")
    new_mf = assign_ids(missing, "manufacturer_name", base, "manufacturer_id") \
        .select(F.col("manufacturer_id").cast(mf.schema["manufacturer_id"].dataType), "manufacturer_name")
    mf2 = insert_missing(mf, new_mf, "manufacturer_id")

    # Step 3: missing model series, make resolved by name (deterministic survivor).
    series = compat.filter(F.col("model_series_id").isNotNull()) \
        .select("model_series_id", "manufacturer_name", "model_name").distinct()
    cand = (series.join(ms.select("model_series_id"), "model_series_id", "left_anti")
            .join(mf2, "manufacturer_name", "left"))
    cand = keep_one(cand, "model_series_id", [F.col("manufacturer_id").asc_nulls_last(), "model_name"])
    new_ms = cand.select("model_series_id", "manufacturer_id", F.col("model_name").alias("display_name"))
    ms2 = ms.unionByName(new_ms, allowMissingColumns=True)

    # Step 4: missing car types with their model series.
    # The least series of a type: one number is held per type, and a type's rows meet folded, not sorted.
    types = compat.filter(F.col("car_type_id").isNotNull()).groupBy("car_type_id").agg(F.min("model_series_id").alias("model_series_id"))
    new_ct = types.join(ct.select("car_type_id"), "car_type_id", "left_anti")
    ct2 = ct.unionByName(new_ct, allowMissingColumns=True)

    # Step 5: repair null manufacturer links of model series.
    sub = keep_one(series.join(mf2, "manufacturer_name"), "model_series_id", ["manufacturer_id"]) \
        .select("model_series_id", "manufacturer_id")
    ms3 = fill_nulls_from(ms2, sub, "model_series_id", "manufacturer_id")
    return {"manufacturers": mf2, "model_series": ms3, "car_types": ct2}


def dimension_gaps(mf: DataFrame, ms: DataFrame, ct: DataFrame, compat: DataFrame) -> DataFrame:
    """Compat car types vs dimension, null manufacturer links, missing make names."""
    c_types = compat.select("car_type_id").distinct()
    return (c_types.agg(F.count(F.lit(1)).alias("compat_car_types"))
            .crossJoin(c_types.join(ct.select("car_type_id"), "car_type_id", "left_semi")
                       .agg(F.count(F.lit(1)).alias("dimension_car_types")))
            .crossJoin(ms.agg(F.count_if(F.col("manufacturer_id").isNull()).cast("bigint")
                              .alias("model_series_null_manufacturer")))
            .crossJoin(compat.select("manufacturer_name").distinct()
                       .join(mf.select("manufacturer_name"), "manufacturer_name", "left_anti")
                       .agg(F.count(F.lit(1)).alias("missing_manufacturer_names"))))


def top_missing_names(mf: DataFrame, compat: DataFrame, top: int = 10) -> DataFrame:
    """Makes absent from the dimension, by distinct articles."""
    return rel.missing_names(compat, "manufacturer_name", mf, "manufacturer_name", "article_id", top)
