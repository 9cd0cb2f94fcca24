"""Quality rules: a threshold table compiled into one projection over each whole text.

Everything is DataFrame expressions.  A first projection splits the text, a second one
counts, and the third holds one boolean per row of the threshold table; there is no
shuffle and no user function.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalog_lake.llm.common import BLANK_CLASS, BLANKS

# The symbols that the symbol count looks for.
SYMBOL_CLASS = r"[#*$%&|<>]+"

# Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "the", "be", "to", "of", "and", "that", "have", "with", "is", "in", "for", "was", "on", "this", "are", "it", "a",
    "le", "la", "les", "de", "des", "du", "et", "un", "une", "est", "que", "qui", "dans", "pour", "avec", "sur", "pas",
    "der", "die", "das", "und", "von", "mit", "ist", "ein", "eine", "nicht", "auch", "auf", "zu", "den", "sich", "für",
    "el", "los", "las", "y", "en", "del", "por", "con", "para", "una", "se", "no", "al", "como", "su", "lo",
)

# Lines that hold a word, that start like a list item, and lines that end cut off.
WORD = r"[^\x20\x09-\x0D]"
# Both are matched against the start or end that is left without the blanks around the line.
BULLET = r"^(?:[-*+]|\u2022|\u2023|\u25CF)[\x20\x09]"
ELLIPSIS = r"(?:\.\.\.|\u2026)\z"


@dataclass(frozen=True)
class Rule:
    """A text passes when ``metric`` is at least ``low`` and at most ``high`` (None: no bound)."""

    name: str
    metric: str
    low: float | None = None
    high: float | None = None


# The production threshold table.
RULES = (
    Rule("word_length", "mean_word_chars", 2.0, 15.0),
    Rule("symbols", "symbol_ratio", None, 0.15),
    Rule("stop_words", "stop_word_ratio", 0.03, None),
    Rule("repeated_lines", "dup_line_ratio", None, 0.50),
    Rule("bullet_lines", "bullet_line_ratio", None, 0.90),
    Rule("cut_lines", "ellipsis_line_ratio", None, 0.30),
)


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row`` (the input row) with the counts and ratios that the rules read.

    A null text counts as empty.  The words in repeated 3-word windows are found by
    sorting the windows' 64-bit hashes with their places: a window repeats when a
    neighbour in that order has its hash, and the places it covers are counted once.
    """
    t = F.coalesce(F.col("row")[text], F.lit(""))
    n, w, h, g = F.size("words"), F.col("words"), F.col("hashes"), F.col("grams")
    split = docs.select(F.struct("*").alias("row")).select(
        "row",
        F.filter(F.split(t, BLANK_CLASS + "+"), lambda x: x != "").alias("words"),
        F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD)).alias("lines"),
        (F.char_length(t) - F.char_length(F.regexp_replace(t, SYMBOL_CLASS, ""))).cast("long").alias("n_symbols"),
    )
    hashed = split.select("*", F.when(n >= 3, F.slice(F.transform(
        w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))), F.lit(1), n - 2)).alias("hashes"))
    # Most texts repeat no window at all: their distinct hashes are as many, and nothing is sorted.
    ordered = hashed.select("*", F.when(F.size(F.array_distinct(h)) < F.size(h), F.sort_array(
        F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))).alias("grams")).drop("hashes")
    starts = F.transform(
        F.filter(g, lambda x, k: x["h"].eqNullSafe(F.get(g, k - 1)["h"]) | x["h"].eqNullSafe(F.get(g, k + 1)["h"])),
        lambda x: x["i"])
    marked = ordered.select("*", F.array_sort(starts).alias("starts")).drop("grams")
    covered = F.aggregate("starts", F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")), lambda acc, i: F.struct(
        i.alias("last"), (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n")), lambda acc: acc["n"])
    n_lines, blanks = F.size("lines"), F.lit(BLANKS)
    counted = marked.select(
        "row", "n_symbols",
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        n.cast("long").alias("n_words"),
        n_lines.cast("long").alias("n_lines"),
        (n_lines - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size(F.filter("words", lambda x: F.lower(x).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.size(F.filter("lines", lambda x: F.substring(F.ltrim(x, blanks), 1, 2).rlike(BULLET))).cast("long").alias("n_bullet_lines"),
        F.size(F.filter("lines", lambda x: F.substring(F.rtrim(x, blanks), -3, 3).rlike(ELLIPSIS))).cast("long").alias("n_ellipsis_lines"),
    )
    per_word = lambda c: F.col(c) / F.greatest(F.col("n_words"), F.lit(1))
    per_line = lambda c: F.col(c) / F.greatest(F.col("n_lines"), F.lit(1))
    return counted.select(
        "*", per_word("word_chars").alias("mean_word_chars"), per_word("n_symbols").alias("symbol_ratio"),
        per_word("n_stop_words").alias("stop_word_ratio"), per_line("n_dup_lines").alias("dup_line_ratio"),
        per_line("n_bullet_lines").alias("bullet_line_ratio"), per_line("n_ellipsis_lines").alias("ellipsis_line_ratio"))


def base_failed() -> Column:
    """Fewer than 50 words, or more than half of the words in repeated windows."""
    return (F.col("n_words") < 50) | (F.lit(100) * F.col("n_repeat_words") > F.lit(50) * F.col("n_words"))


def compile_rules(rules: tuple[Rule, ...] = RULES) -> dict[str, Column]:
    """One boolean column per row of the threshold table: true where the text passes."""
    out = {}
    for r in rules:
        c = F.col(r.metric)
        bounds = [c >= F.lit(r.low)] * (r.low is not None) + [c <= F.lit(r.high)] * (r.high is not None)
        out[r.name] = reduce(Column.__and__, bounds, F.lit(True))
    return out


def apply_rules(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``row``, the measures, ``base_failed``, ``passed_<rule>`` for each rule and ``kept``.

    Rows come out one for one, repeated rows too.  A null, empty or blank text has no
    words, fails the base rule and is not kept.  An empty table gives an empty result.
    Extra columns travel inside ``row``, so no name can clash.
    """
    compiled = compile_rules(rules)
    verdict = reduce(Column.__and__, compiled.values(), F.lit(True))
    return measures(docs, text).select(
        "*", base_failed().alias("base_failed"), *[c.alias(f"passed_{k}") for k, c in compiled.items()],
        (~base_failed() & verdict).alias("kept"))


def keep_good(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows that the rules keep, with their own columns.

    Spark would push a plain filter on ``kept`` below the projections and repeat the
    splitting and counting for each mention of their columns.  It does not move a filter
    past a projection with a row number in it, so every text is measured once.
    """
    measured_once = F.col("kept") & (F.monotonically_increasing_id() >= 0)
    return apply_rules(docs, text, rules).select("row", measured_once.alias("kept")).where("kept").select("row.*")
