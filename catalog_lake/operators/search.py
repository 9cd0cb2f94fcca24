"""Weighted full-text search over a postings table.

Index
    ``postings(token, article_id, field, weight, pos)``: one row per token
    occurrence of part_name (A), part_number (B), article_number (B) and
    article_manufacturer (C), tokenised like a 'simple' dictionary: lower
    case, split on anything that is not a letter or digit, no stemming, no
    stop words.  Written sorted by token, a Parquet postings table lets a
    query read only the row groups of its tokens (min/max pruning).

Query
    web-search syntax: words are AND-ed, ``"quoted phrase"`` needs adjacent
    positions in one field, ``or`` between two items makes them
    alternatives, ``-word`` excludes.  The string is parsed on the driver
    (it is a few words); matching and ranking are one scan of the query's
    postings and one aggregate per article, phrases included.

Rank (own formula, documented; not bit-equal to any other engine)
    Σ over positive query tokens Σ over fields  weight(field) × tf / (tf + 1)
    with weights A = 1.0, B = 0.4, C = 0.2; ties broken by article_id.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalog_lake.functions.text import ilike_contains

TOKEN_SPLIT = r"[^\p{L}\p{N}]+"
FIELD_WEIGHTS = {"part_name": ("A", 1.0), "part_number": ("B", 0.4), "article_number": ("B", 0.4),
                 "article_manufacturer": ("C", 0.2)}


def tokens_of(c: Column) -> Column:
    """Tokens of a text column (array, empties removed, positions kept by posexplode)."""
    return F.split(F.lower(F.coalesce(c, F.lit(""))), TOKEN_SPLIT)


def build_postings(articles: DataFrame, details: DataFrame | None = None) -> DataFrame:
    """Postings of the four weighted fields.

    ``article_number`` comes from the details (left join: articles never
    carry it themselves, quirk 2 fixed).
    """
    a = articles.select("article_id", "part_name", "part_number", "article_manufacturer")
    if details is not None:
        a = a.join(details.select("article_id", "article_number"), "article_id", "left")
    else:
        a = a.withColumn("article_number", F.lit(None).cast("string"))
    parts = []
    for f, (cls, w) in FIELD_WEIGHTS.items():
        parts.append(a.select("article_id", F.lit(f).alias("field"), F.lit(cls).alias("weight_class"),
                              F.lit(w).alias("weight"), F.posexplode(tokens_of(F.col(f))).alias("pos", "token")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.filter(F.col("token") != "").select("token", "article_id", "field", "weight_class", "weight",
                                                   F.col("pos").cast("bigint").alias("pos"))


# -- query parsing (driver side, the query string only) ---------------------------
@dataclass
class WebQuery:
    """Alternatives (``or``), each a conjunction of (excluded, phrase); a phrase is a token list."""

    alternatives: list[list[tuple[bool, list[str]]]] = field(default_factory=list)

    @property
    def positive_tokens(self) -> list[str]:
        return sorted({t for alt in self.alternatives for excluded, p in alt if not excluded for t in p})

    @property
    def all_tokens(self) -> list[str]:
        return sorted({t for alt in self.alternatives for _, p in alt for t in p})


def _split_tokens(text: str) -> list[str]:
    return [t for t in re.split(r"[^\w]+|_", text.lower()) if t]


def parse_web_query(q: str) -> WebQuery:
    """Websearch syntax: words AND-ed, ``"phrase"``, ``-word``; ``or`` binds weaker than AND."""
    alternatives: list[list[tuple[bool, list[str]]]] = [[]]
    for m in re.finditer(r'(-?)"([^"]*)"?|(\S+)', q or ""):
        word = m.group(3)
        if word is not None and word.lower() == "or":
            alternatives.append([])
            continue
        excluded = bool(m.group(1)) if word is None else word.startswith("-") and len(word) > 1
        if toks := _split_tokens(m.group(2) if word is None else word):
            alternatives[-1].append((excluded, toks))
    return WebQuery([alt for alt in alternatives if alt])


# -- matching and ranking --------------------------------------------------------
def _holds(phrase: list[str], numbers: dict[str, int]) -> Column:
    """Whether the article has the phrase: its tokens at adjacent positions of one field."""
    first, *rest = (F.col(f"at{numbers[t]}") for t in phrase)
    if not rest:
        return F.size(first) > 0
    return F.exists(first, lambda x: reduce(lambda a, b: a & b, [
        F.array_contains(at, F.struct(x["field"].alias("field"), (x["pos"] + i).alias("pos"))) for i, at in enumerate(rest, start=1)]))


def _times(places: str, field_name: str) -> Column:
    """How often a token stands in the field."""
    return F.size(F.filter(places, lambda x: x["field"] == field_name))


def scored(postings: DataFrame, q: str | WebQuery) -> tuple[DataFrame, bool]:
    """S2 + S3 in one scan: (article_id, matches, relevance) of the articles with a token of the query,
    and whether an article with none of them matches too.

    One aggregate per article over the query's postings, however many words there are: the
    places of each token, from which phrases are tested by array functions, and the rank.
    The places of an article are bounded by its four short fields.
    """
    wq = parse_web_query(q) if isinstance(q, str) else q
    numbers = {t: i for i, t in enumerate(wq.all_tokens)}
    places = [F.collect_list(F.when(F.col("token") == t, F.struct("field", F.col("pos").cast("bigint").alias("pos")))).alias(f"at{i}")
              for t, i in numbers.items()]
    hits = postings.filter(F.col("token").isin(wq.all_tokens)).groupBy("article_id").agg(*places) if numbers else \
        postings.select("article_id").limit(0)
    relevance = F.lit(0.0)
    for t in wq.positive_tokens:  # a token that only stands in excluded phrases has no rank
        for f, (_, weight) in FIELD_WEIGHTS.items():
            tf = _times(f"at{numbers[t]}", f)
            relevance = relevance + weight * tf / (tf + 1)
    found = [reduce(lambda a, b: a & b, [~_holds(p, numbers) if excluded else _holds(p, numbers) for excluded, p in alt])
             for alt in wq.alternatives]
    matches = reduce(lambda a, b: a | b, found) if found else F.lit(False)
    return hits.select("article_id", matches.alias("matches"), relevance.alias("relevance")), any(
        all(excluded for excluded, _ in alt) for alt in wq.alternatives)


def with_relevance(rows: DataFrame, postings: DataFrame, q: str | WebQuery) -> DataFrame:
    """The rows (with ``article_id``) that match the query, and their relevance: one join with ``scored``."""
    hits, others = scored(postings, q)
    if not others:
        return rows.join(hits.filter("matches").select("article_id", "relevance"), "article_id")
    return rows.join(hits, "article_id", "left").filter(F.coalesce("matches", F.lit(True))).drop("matches") \
        .withColumn("relevance", F.coalesce("relevance", F.lit(0.0)))


def match(postings: DataFrame, q: str | WebQuery, universe: DataFrame) -> DataFrame:
    """Article ids (from ``universe``) matching the web query."""
    return with_relevance(universe.select("article_id"), postings, q).select("article_id")


def rank(postings: DataFrame, q: str | WebQuery) -> DataFrame:
    """S3: (article_id, relevance) over the query's positive tokens."""
    return scored(postings, q)[0].filter("relevance > 0").select("article_id", "relevance")


def keyword_search(articles: DataFrame, postings: DataFrame, q: str, limit: int | None = 20,
                   car: DataFrame | None = None) -> DataFrame:
    """Q7: matches ranked by relevance (desc, then article_id), optional car filter."""
    rows = articles if car is None else articles.join(car.select("article_id"), "article_id", "left_semi")
    out = with_relevance(rows, postings, q).withColumn("relevance", F.round("relevance", 6))
    out = out.orderBy(F.desc("relevance"), "article_id")
    return out.limit(limit) if limit else out


def car_filter(compat: DataFrame, make: str | None = None, model: str | None = None,
               year: str | int | None = None, year_mode: str = "year") -> DataFrame | None:
    """The compat side of S4: make/model contains (ILIKE) and year overlap; None if no condition."""
    from catalog_lake.functions.filters import all_of, year_overlap
    if not (make or model or year):
        return None
    cond = all_of(ilike_contains(F.col("manufacturer_name"), make) if make else None,
                  ilike_contains(F.col("model_name"), model) if model else None,
                  year_overlap("year_from", "year_to", year, year_mode) if year else None)
    return compat.filter(cond).select("article_id")


def _bound(table: DataFrame | Callable[[], DataFrame]) -> DataFrame:
    """A table, or what binds it: building one that a search does not read can be all of its work."""
    return table() if callable(table) else table


def search(articles: DataFrame, postings: DataFrame | Callable[[], DataFrame], compat: DataFrame | Callable[[], DataFrame], q: str = "", make: str | None = None,
           model: str | None = None, year: str | int | None = None, is_oem: bool | None = None,
           page: int = 1, limit: int = 20, year_mode: str = "year") -> tuple[DataFrame, DataFrame]:
    """Faceted search -> (page of results, one-row total).

    Only the supplied filters apply (F14); filters run before ranking; with
    no query text the order is article_id.  Both outputs come from the same
    filtered frame, so callers can cache it when serving both.
    """
    if page < 1 or not 1 <= limit <= 100:
        raise ValueError("page >= 1 and 1 <= limit <= 100")
    filtered = articles
    if is_oem is not None:
        filtered = filtered.filter(F.col("is_oem") == F.lit(is_oem))
    cars = car_filter(_bound(compat), make, model, year, year_mode) if make or model or year else None
    if cars is not None:
        filtered = filtered.join(cars, "article_id", "left_semi")
    qc = (q or "").strip()
    if qc:
        filtered = with_relevance(filtered, _bound(postings), qc).withColumn("relevance", F.round("relevance", 6))
        ordered = filtered.orderBy(F.desc("relevance"), "article_id")
    else:
        ordered = filtered.withColumn("relevance", F.lit(None).cast("double")).orderBy("article_id")
    rows = ordered.offset((page - 1) * limit).limit(limit) if page > 1 else ordered.limit(limit)
    total = filtered.agg(F.count(F.lit(1)).alias("total"))
    return rows, total


def with_numbers(rows: DataFrame, details: DataFrame) -> DataFrame:
    """a page of results with the article number of its details (null without any), in the page's order.

    Joined after the page is cut, so the details are read for at most a page of articles."""
    order = [F.desc_nulls_last("relevance"), "article_id"]
    return rows.join(details.select("article_id", "article_number"), "article_id", "left").orderBy(*order)


def index_health(articles: DataFrame, postings: DataFrame) -> DataFrame:
    """Articles that have at least one posting vs all articles."""
    with_vec = articles.join(postings.select("article_id"), "article_id", "left_semi")
    return (articles.agg(F.count(F.lit(1)).alias("articles"))
            .crossJoin(with_vec.agg(F.count(F.lit(1)).alias("articles_with_search_vector"))))


def trigram_postings(df: DataFrame, key: str, col: str) -> DataFrame:
    """S6 index: distinct lower-case 3-grams of a text column."""
    low = F.lower(F.coalesce(F.col(col), F.lit("")))
    grams = F.transform(F.sequence(F.lit(1), F.greatest(F.length(low) - 2, F.lit(1))),
                        lambda i: F.substring(low, i, 3))
    return df.select(key, F.explode(F.array_distinct(grams)).alias("gram")).filter(F.length("gram") == 3)


def build_grams(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """S6 index of several columns: (field, gram, key)."""
    return reduce(DataFrame.unionByName, [trigram_postings(df, key, c).select(F.lit(c).alias("field"), "gram", key) for c in cols])


def contains_search(df: DataFrame, key: str, col: str, x: str, grams: DataFrame | None = None) -> DataFrame:
    """``col ILIKE '%x%'``; with a trigram index, candidates are prefiltered first.

    A row contains ``x`` only if it has all of x's trigrams, so the index
    gives a superset that the ILIKE check then makes exact.
    """
    cand = df
    # Only literal stretches have grams: ILIKE reads % and _ as wildcards.
    need = sorted({run[i:i + 3] for run in re.split(r"[%_\\]", x.lower()) for i in range(len(run) - 2)})
    if grams is not None and need:
        hit = (grams.filter(F.col("gram").isin(need)).groupBy(key)
               .agg(F.countDistinct("gram").alias("n")).filter(F.col("n") == len(need)))
        cand = df.join(hit.select(key), key, "left_semi")
    return cand.filter(ilike_contains(F.col(col), x))
