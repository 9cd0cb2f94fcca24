"""Explicit schemas of the seven crawled entities and the side records.

Inference reads ids as strings in some rounds and breaks joins, so every
reader passes one of these; inference stays an exploration option.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, B = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType()


def _f(name, typ):
    return T.StructField(name, typ, True)


KV = T.ArrayType(T.StructType([_f("key", S), _f("value", S)]))
SCOPE = [_f("lang_id", I), _f("country_id", I), _f("type_id", I)]

COMPAT_ELEMENT = T.StructType([_f("car_type_id", I), _f("model_series_id", I), _f("manufacturer_name", S),
                               _f("model_name", S), _f("engine_or_variant", S), _f("year_from", S),
                               _f("year_to", S), _f("extra_qualifier", S)])

SCHEMAS: dict[str, T.StructType] = {
    "manufacturers": T.StructType([_f("manufacturer_id", I), _f("name", S), _f("url", S), *SCOPE]),
    "models": T.StructType([_f("model_series_id", I), _f("manufacturer_id", I), _f("display_name", S),
                            _f("model_native_name", S), _f("from_date", S), _f("to_date", S), _f("url", S),
                            *SCOPE]),
    "car_types": T.StructType([_f("car_type_id", I), _f("model_series_id", I), _f("manufacturer_id", I),
                               _f("type_label", S), _f("engine_code", S), _f("cylinder", I), _f("capacity", S),
                               _f("fuel_type", S), _f("year_range", S), _f("year_from", I), _f("year_to", I),
                               _f("power", S), _f("category_url", S), _f("details_url", S), *SCOPE]),
    "car_type_details": T.StructType([_f("car_type_id", I), _f("manufacturer_id", I), _f("model_series_id", I),
                                      _f("details_url", S), _f("car_type_title", S),
                                      _f("construction_interval", S), _f("year_from", I), _f("year_to", I),
                                      _f("details", KV), *SCOPE]),
    "category_groups": T.StructType([_f("group_id", I), _f("car_type_id", I), _f("manufacturer_id", I),
                                     _f("model_series_id", I), _f("primary_group_name", S),
                                     _f("subcategory_name", S), _f("sub_subcategory_name", S),
                                     _f("group_name", S), _f("list_articles_url", S),
                                     _f("list_oem_articles_url", S), *SCOPE]),
    "articles": T.StructType([_f("article_id", L), _f("part_name", S), _f("part_number", S),
                              _f("article_manufacturer", S), _f("supplier_id", I), _f("product_id", I),
                              _f("thumbnail_url", S), _f("details_url", S), _f("model_series_id", L),
                              _f("manufacturer_id", L), _f("group_id", L), _f("car_type_id", L), *SCOPE,
                              _f("is_oem", B)]),
    "article_details": T.StructType([_f("article_id", L), _f("model_series_id", I), _f("manufacturer_id", I),
                                     _f("group_id", I), _f("car_type_id", I), _f("details_url", S),
                                     _f("article_name", S), _f("article_number", S),
                                     _f("ean_numbers", T.ArrayType(S)),
                                     _f("oem_numbers", T.ArrayType(T.StructType([_f("brand", S), _f("number", S)]))),
                                     _f("image_urls", T.ArrayType(S)), _f("technical_details", KV),
                                     _f("compatible_cars", T.ArrayType(COMPAT_ELEMENT)), *SCOPE]),
    "seen_urls": T.StructType([_f("url", S), _f("status_code", I), _f("timestamp", S), _f("error_message", S)]),
    "images_manifest": T.StructType([_f("article_id", L), _f("image_index", I), _f("url", S), _f("status", S),
                                     _f("path", S), _f("bytes", L), _f("error", S)]),
}

# Primary key per entity (the dedup and upsert key).
PRIMARY_KEYS: dict[str, str] = {
    "manufacturers": "manufacturer_id", "models": "model_series_id", "car_types": "car_type_id",
    "car_type_details": "car_type_id", "category_groups": "group_id", "articles": "article_id",
    "article_details": "article_id",
}

ENTITIES = list(PRIMARY_KEYS)
