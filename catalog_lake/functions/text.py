"""Scalar Column functions — all Catalyst expressions.

Each function takes and returns a ``Column`` so it composes inside ``select``
and ``filter`` and stays within whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's (url grammar, labels, formats).
# ---------------------------------------------------------------------------
URL_PATTERNS: dict[str, tuple[str, tuple[str, ...]]] = {
    "manufacturer": (r"/models/manufacturer-id-(\d+)/", ("manufacturer_id",)),
    "model_series": (r"/passenger-car-types/(\d+)/manufacturer-id-(\d+)/",
                     ("model_series_id", "manufacturer_id")),
    "car_type_details": (r"/passenger-car-type-details/(\d+)/manufacturer-id-(\d+)/",
                         ("car_type_id", "manufacturer_id")),
    "category_page": (r"/list-category-products-groups/(\d+)/manufacturer-id-(\d+)/",
                      ("car_type_id", "manufacturer_id")),
    "list_articles": (r"/list-articles/(\d+)/(\d+)/manufacturer-id-(\d+)/",
                      ("car_type_id", "group_id", "manufacturer_id")),
    "list_oem_articles": (r"/list-oem-articles/(\d+)/(\d+)/manufacturer-id-(\d+)/",
                          ("car_type_id", "group_id", "manufacturer_id")),
    "article_details": (r"/article-details/(\d+)/model-series-id-(\d+)/manufacturer-id-(\d+)/",
                        ("article_id", "model_series_id", "manufacturer_id")),
}
ARTICLE_ID_IN_URL = r"/article-details/(\d+)/"
IMAGE_EXTENSIONS = [".webp", ".jpg", ".jpeg", ".png", ".gif", ".avif"]
DEFAULT_IMAGE_EXTENSION = ".bin"
BANNER_PREFIX = "AUTO PARTS CATALOG"
SKIPPED_HEADINGS = ["tehnic details", "image details", "compatible cars"]
CARD_LABELS = {"part_number": "Article Part No", "article_manufacturer": "Manufacturer",
               "supplier_id": "Supplier ID", "product_id": "Products ID"}


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


# -- D1 / D2 / D3 / D28: urls ---------------------------------------------
def normalize_url(u: Column | str) -> Column:
    """Drop all whitespace; null becomes ''."""
    def strip(url: Column) -> Column:
        blank = [url.contains(c) for c in " \t\n\x0b\f\r"]  # seen at once that there is none, which is so of nearly all urls
        return F.when(reduce(Column.__or__, blank), F.regexp_replace(url, r"\s+", "")).otherwise(url)

    return let(F.coalesce(_c(u), F.lit("")), strip)


def _url_has(url: Column, kind: str) -> Column:
    """Whether a url matches the kind's pattern; tried only where its fixed beginning stands."""
    pattern, _ = URL_PATTERNS[kind]
    return url.contains(pattern[:pattern.index("(")]) & url.rlike(pattern)


def parse_url_ids(u: Column | str, kind: str, normalized: bool = False) -> Column:
    """Named ids of one url kind as a struct, or null when the url is another kind.

    ``normalized=True`` skips D1 when the caller already normalised the column.
    """
    pattern, names = URL_PATTERNS[kind]
    def ids(url: Column) -> Column:
        # What matches, cut at all that is no digit, which is all but the ids.
        return let(F.split(F.regexp_extract(url, pattern, 0), "[^0-9]+"), lambda found: F.when(F.size(found) > 1, F.struct(
            *[F.get(found, F.lit(i + 1)).try_cast("bigint").alias(n) for i, n in enumerate(names)])))

    return let(_c(u) if normalized else normalize_url(u), lambda url: F.when(url.contains(pattern[:pattern.index("(")]), ids(url)))


def url_kind(u: Column | str, normalized: bool = False) -> Column:
    """Which of the seven url kinds ``u`` is (first match in declaration order), else null."""
    url = _c(u) if normalized else normalize_url(u)
    expr = None
    for kind in URL_PATTERNS:
        expr = F.when(_url_has(url, kind), F.lit(kind)) if expr is None else expr.when(_url_has(url, kind), F.lit(kind))
    return expr


def absolutize(base: str, href: Column | str) -> Column:
    """D3: keep http(s) hrefs, else ``base`` (no trailing /) + '/' + href (no leading /)."""
    h = _c(href)
    root = base.rstrip("/")
    return F.when(h.startswith("http://") | h.startswith("https://"), h).otherwise(
        F.concat(F.lit(root + "/"), F.ltrim(h, F.lit("/"))))


def article_id_from_url(u: Column | str) -> Column:
    """Article id embedded in a details url, null if absent."""
    return F.regexp_extract(_c(u), ARTICLE_ID_IN_URL, 1).try_cast("bigint")


# -- D4 / D5 / D6 / D7 / D8: numbers and years ------------------------------
def safe_int(c: Column | str) -> Column:
    """Trim, drop commas, digits only -> bigint; anything else (incl. negatives) -> null."""
    v = F.replace(F.trim(F.coalesce(_c(c), F.lit(""))), F.lit(","), F.lit(""))
    return F.when(v.rlike(r"^[0-9]+$"), v.try_cast("bigint"))


def year_range(c: Column | str) -> Column:
    """First and second 4-digit runs -> struct(year_from, year_to)."""
    runs = F.regexp_extract_all(F.coalesce(_c(c), F.lit("")), F.lit(r"(\d{4})"), 1)
    return F.struct(safe_int(F.try_element_at(runs, F.lit(1))).alias("year_from"),
                    safe_int(F.try_element_at(runs, F.lit(2))).alias("year_to"))


def interval_years(c: Column | str) -> Column:
    """D5: 'From: [mm/]yyyy ... To: [mm/]yyyy' (case-insensitive) -> struct(year_from, year_to)."""
    t = F.coalesce(_c(c), F.lit(""))

    def grab(label: str) -> Column:
        return safe_int(F.regexp_extract(t, rf"(?i){label}[:\s]+(?:\d{{1,2}}[/\-])?(\d{{4}})", 1))
    return F.struct(grab("From").alias("year_from"), grab("To").alias("year_to"))


def labelled_date(c: Column | str, label: str) -> Column:
    """Text after ``label:`` made of digits and dashes, '' when absent."""
    return F.regexp_extract(F.coalesce(_c(c), F.lit("")), rf"{label}:\s*([\d\-]+)", 1)


def to_int(c: Column | str) -> Column:
    """Lenient integer, null on failure; a fractional *number* (not text) loses its fraction."""
    col = _c(c)
    fractional = F.typeof(col).isin("double", "float") | F.typeof(col).startswith("decimal")
    whole = col.try_cast("double").try_cast("bigint")
    return F.coalesce(F.trim(col.cast("string")).try_cast("bigint"), F.when(fractional, whole))


def json_number_to_int(c: Column | str) -> Column:
    """D8 for a JSON number read as text: ``1.0`` and ``12.7`` are numbers and give 1 and 12."""
    col = F.trim(_c(c))
    number = col.rlike(r"^[+-]?[0-9]+\.[0-9]+([eE][+-]?[0-9]+)?$|^[+-]?[0-9]+[eE][+-]?[0-9]+$")
    return F.coalesce(to_int(col), F.when(number, col.try_cast("double").try_cast("bigint")))


# -- D9 .. D13, D24, D26: null discipline, lists, json -------------------
def to_text(c: Column | str) -> Column:
    """Null -> ''; other values as text."""
    return F.coalesce(_c(c).cast("string"), F.lit(""))


def to_list(c: Column | str, element_type: str = "string") -> Column:
    """Null list -> empty list of the element type."""
    return F.coalesce(_c(c), F.array().cast(f"array<{element_type}>"))


def bool_default(c: Column | str) -> Column:
    """Null flag -> false."""
    return F.coalesce(_c(c), F.lit(False))


def list_json(c: Column | str) -> Column:
    """List -> JSON text (null list -> '[]')."""
    return F.coalesce(F.to_json(_c(c)), F.lit("[]"))


def dedup_list(c: Column | str) -> Column:
    """Order-preserving dedup (first occurrence kept)."""
    return F.array_distinct(_c(c))


def list_size(c: Column | str) -> Column:
    """Length of a nullable list (null -> 0)."""
    return F.coalesce(F.array_size(_c(c)), F.lit(0)).cast("bigint")


def pct(a: Column | str, b: Column | str, digits: int = 1) -> Column:
    """100*a/b rounded; null when b is 0 (ANSI-safe)."""
    return F.round(_c(a).cast("double") * 100.0 / F.nullif(_c(b).cast("double"), F.lit(0.0)), digits)


# -- D16, D17: names -------------------------------------------------------
def compact_name(c: Column | str) -> Column:
    """Remove spaces."""
    return F.replace(_c(c), F.lit(" "), F.lit(""))


def prefix_keys(c: Column | str) -> Column:
    """Prefixes of length 3, 2, 1 that exist."""
    v = _c(c)
    return F.filter(F.array(*[F.when(F.length(v) >= n, F.substring(v, 1, n)) for n in (3, 2, 1)]),
                    lambda x: x.isNotNull())


# -- D19 .. D23, D27: page fragments and files ---------------------------
def css_url(c: Column | str) -> Column:
    """The target of a CSS ``url(...)``, quotes and blanks stripped; '' when absent."""
    raw = F.regexp_extract(F.coalesce(_c(c), F.lit("")), r"url\(([^)]+)\)", 1)
    return let(raw, lambda url: F.when(url.contains("'") | url.contains('"') | url.contains(" "), F.regexp_replace(url, r"^['\" ]+|['\" ]+$", ""))
               .otherwise(url))


def labelled(c: Column | str, label: str, numeric: bool = False) -> Column:
    """Value after a card label (``Supplier ID:`` etc.).

    Text values: the label and any ':'/blanks after it removed; numeric values:
    the first digit run after the label, case-insensitive, else null.
    """
    t = F.coalesce(_c(c), F.lit(""))
    if numeric:
        d = F.regexp_extract(t, rf"(?i){label}[:\s]*(\d+)", 1)
        return F.when(t.startswith(label) & (d != ""), d.try_cast("bigint"))
    return F.when(t.startswith(label), F.trim(F.regexp_replace(t, rf"^{label}[:\s]*", "")))


def oem_brand(key: Column | str) -> Column:
    """Brand part of an 'OEM Numbers …' key: label removed, ': ' stripped from both ends."""
    return F.regexp_replace(F.replace(_c(key), F.lit("OEM Numbers"), F.lit("")), r"^[: ]+|[: ]+$", "")


def guess_ext(u: Column | str) -> Column:
    """First of six image extensions the url ends with, else '.bin'."""
    low = F.lower(F.coalesce(_c(u), F.lit("")))
    expr = None
    for ext in IMAGE_EXTENSIONS:
        expr = F.when(low.endswith(ext), F.lit(ext)) if expr is None else expr.when(low.endswith(ext), F.lit(ext))
    return expr.otherwise(F.lit(DEFAULT_IMAGE_EXTENSION))


def image_path(article_id: Column | str, index: Column | str, url: Column | str) -> Column:
    """``{id % 1000 zero-padded to 3}/article_{id}_img_{n}{ext}``."""
    a = _c(article_id)
    shard = F.lpad(F.pmod(a, F.lit(1000)).cast("string"), 3, "0")
    name = F.concat(F.lit("article_"), a.cast("string"), F.lit("_img_"), _c(index).cast("string"),
                    guess_ext(url))
    return F.concat(shard, F.lit("/"), name)


def pick_heading(headings: Column | str) -> Column:
    """First non-empty heading that is neither the banner nor a section title."""
    skip = F.array(*[F.lit(s) for s in SKIPPED_HEADINGS])
    cand = F.filter(_c(headings), lambda h: (F.trim(h) != "")
                    & ~F.upper(F.trim(h)).startswith(BANNER_PREFIX)
                    & ~F.array_contains(skip, F.lower(F.trim(h))))
    return F.coalesce(F.try_element_at(cand, F.lit(1)), F.lit(""))


def kv_get(pairs: Column | str, name: str) -> Column:
    """First value whose lower-cased key equals ``name``; '' if none."""
    hit = F.filter(_c(pairs), lambda kv: F.lower(kv["key"]) == name.lower())
    return F.coalesce(F.try_element_at(hit, F.lit(1))["value"], F.lit(""))


# -- F-series helpers used by plans ----------------------------------------
def ilike_contains(c: Column, x: str) -> Column:
    """``ILIKE '%x%'`` (wildcards inside ``x`` are not escaped, as in the reference)."""
    return c.ilike(f"%{x}%")


def is_blank(c: Column | str) -> Column:
    """null or ''."""
    col = _c(c)
    return col.isNull() | (col == "")


def join_nonempty(sep: str, *cols: Column | str) -> Column:
    """F16: ``A > B > C`` skipping blank parts."""
    return F.concat_ws(sep, *[F.nullif(_c(c), F.lit("")) for c in cols])


def partition_label(c: Column | str) -> Column:
    """A partition value read as int in one round and text in another -> text."""
    return _c(c).cast("string")


def round_number(label: Column | str) -> Column:
    """Numeric part of a round label (``r10`` -> 10) so ``r9`` orders before ``r10``."""
    return F.regexp_extract(_c(label), r"(\d+)", 1).try_cast("bigint")
