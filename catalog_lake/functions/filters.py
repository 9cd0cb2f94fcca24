"""Row predicates and filter helpers.

Predicates are Columns so Catalyst can push the simple ones into the Parquet
scan and combine them; helpers that need a second table are joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalog_lake.functions.text import _c, normalize_url, safe_int

# Fixed value that must equal the reference's default gate.
MIN_YEAR_TO = 2006


def year_gate(year_to_text: Column | str, min_year: int = MIN_YEAR_TO) -> Column:
    """keep when the end year is null, blank or not a number; else it must be >= min_year."""
    y = safe_int(_c(year_to_text).cast("string"))
    return y.isNull() | (y >= min_year)


def effective_year_to(car_types: DataFrame, details: DataFrame, min_year: int = MIN_YEAR_TO) -> DataFrame:
    """the table end year, else the details-page end year; gate; then require a category url.

    Details are joined for every car type that has them (the reference skips
    the page on resume, quirk 8; here all known details count).
    """
    d = details.select("car_type_id", F.col("year_to").alias("_details_year_to"))
    out = car_types.join(d, "car_type_id", "left").withColumn(
        "effective_year_to", F.coalesce(F.col("year_to"), F.col("_details_year_to")))
    return (out.filter(year_gate("effective_year_to", min_year))
            .filter(F.coalesce(F.col("category_url"), F.lit("")) != "")
            .drop("_details_year_to"))


def in_scope(url: Column | str, lang_id: int, country_id: int, type_id: int) -> Column:
    """lang and country segments present (segment boundary), and the type segment
    present unless it is a car-type-details url."""
    u = normalize_url(url)
    return (u.rlike(rf"/lang-id-{lang_id}(/|$)") & u.rlike(rf"/country-filter-id-{country_id}(/|$)")
            & (u.rlike(rf"/type-id-{type_id}(/|$)") | u.contains("/passenger-car-type-details/")))


def year_overlap(year_from: Column | str, year_to: Column | str, year: int | str, mode: str = "year") -> Column:
    """the interval [from, to] contains ``year``; blank ends are open.

    ``mode='text'`` compares text as the reference does ('2015-01-01' <= '2015'
    is false, quirk 6); ``mode='year'`` compares the 4-digit years.
    """
    f, t = F.coalesce(_c(year_from), F.lit("")), F.coalesce(_c(year_to), F.lit(""))
    if mode == "text":
        y = F.lit(str(year))
        return ((f == "") | (f <= y)) & ((t == "") | (t >= y))
    if mode != "year":
        raise ValueError("mode is 'text' or 'year'")
    yf = F.substring(f, 1, 4).try_cast("int")
    yt = F.substring(t, 1, 4).try_cast("int")
    y = F.lit(int(year))
    return ((f == "") | (yf <= y)) & ((t == "") | (yt >= y))


def by_key(df: DataFrame, col: str, value) -> DataFrame:
    """F8: point lookup (pushed to the Parquet scan)."""
    return df.filter(F.col(col) == value)


def foreign_urls(urls: Column | str, allowed_like: Sequence[str]) -> Column:
    """url matches none of the allowed LIKE patterns and is not ''."""
    u = _c(urls)
    cond = u != ""
    for p in allowed_like:
        cond = cond & ~u.like(p)
    return cond


def require_key(df: DataFrame, *pk: str) -> DataFrame:
    """drop rows whose key did not parse."""
    cond = None
    for k in pk:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.filter(cond)


def all_of(*conds: Column | None) -> Column:
    """conjunction of the supplied conditions only (None = not supplied)."""
    out = F.lit(True)
    for c in conds:
        if c is not None:
            out = out & c
    return out


def malformed_first(json_list: Column | str, keys: Sequence[str]) -> Column:
    """a non-empty JSON list whose first element lacks one of ``keys``; a key with a null value is there."""
    j = _c(json_list)
    nonempty = j.isNotNull() & (j != "[]")
    has = F.json_object_keys(F.get_json_object(j, "$[0]"))
    return nonempty & ~F.coalesce(F.size(F.array_intersect(has, F.array(*map(F.lit, keys)))) == len(set(keys)), F.lit(False))


def invalid_range(year_from: Column | str, year_to: Column | str) -> Column:
    """both ends non-empty and from > to (text comparison, as stored)."""
    f, t = _c(year_from), _c(year_to)
    return (f != "") & (t != "") & (f > t)
