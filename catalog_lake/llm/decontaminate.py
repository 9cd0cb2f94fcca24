"""Benchmark decontamination by a prefix-filtered set join.

A benchmark item's windows are the records.  Each window's shingles are ordered by
rarity in the corpus; as a window must be contained whole, the one rarest shingle is its
necessary prefix.  A scan of the documents emits only places of such prefix shingles,
with the words around them; they are joined to the windows by that shingle, bounded by
length and position (enough words before and after), and verified word by word.

The documents are scanned twice: for the shingles' corpus counts, and for the places.
Only a bit table of fixed size is broadcast; the benchmark itself may grow.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from catalog_lake.llm.common import cut, text_key

WINDOW = 13
SHINGLE = 5
#: Bits of the table that tells whether a shingle may matter: 2 MiB, whatever the benchmark's size.
TABLE_BITS = 24
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")  # after lower-casing A-Z; UTF-8 bytes from 0x80 belong to words


def words_of(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode().lower())


class Hashes(dict):
    """Word -> 64-bit hash, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word)
        if len(self) < 200_000:
            self[word] = h
        return h


def shingle_hashes(words: list[bytes], n: int, known: Hashes) -> np.ndarray:
    """A 64-bit hash of every run of ``n`` words."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    w = np.array([known[x] for x in words], np.uint64)
    h = np.full(len(w) - n + 1, n, np.uint64)
    for i in range(n):
        h = (h ^ w[i:len(w) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def _windows(bench: DataFrame, item: str, text: str, window: int, shingle: int) -> DataFrame:
    """(item, win, words, k, o, h): every window of every item with its shingles' offsets and hashes."""
    kind = bench.schema[item].dataType
    arrow = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Hashes()
        for b in batches:
            for ident, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ws = words_of(t)
                k = min(window, len(ws))
                n = min(shingle, k)
                rows = [(ident, b" ".join(ws[s:s + k]).decode(), k, o)
                        for s in range(len(ws) - k + 1) for o in range(k - n + 1)] if ws else []
                h = shingle_hashes(ws, n, known).view(np.int64) if ws else []
                hs = [int(h[s + o]) for s in range(len(ws) - k + 1) for o in range(k - n + 1)] if ws else []
                cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip([*cols, hs], [arrow, pa.string(), pa.int32(), pa.int32(), pa.int64()], strict=True)],
                    ["item", "words", "k", "o", "h"])

    rows = bench.select(F.col(item).alias("item"), F.col(text).alias("text")) \
        .mapInArrow(run, f"item {kind.simpleString()}, words string, k int, o int, h bigint")
    return rows.withColumn("win", text_key("words"))


def _table(shingles: DataFrame) -> np.ndarray:
    """The bit table of the hashes ``h``: at most 2^(TABLE_BITS - 6) longs reach the driver."""
    slot = F.shiftrightunsigned("h", 64 - TABLE_BITS)
    rows = shingles.select(F.shiftrightunsigned(slot, 6).alias("at"),
                           F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {64 - TABLE_BITS}) & 63 as int))").alias("bit")) \
        .groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (TABLE_BITS - 6), np.int64)
    out[rows.column("at").to_numpy()] = rows.column("bits").to_numpy()
    return out.view(np.uint64)


def _may_be(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    slot = h >> np.uint64(64 - TABLE_BITS)
    return (table[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) != 0


def _corpus_counts(docs: DataFrame, text: str, lengths: list[int], table) -> DataFrame:
    """(h, n): places of each shingle of the benchmark over all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, bits = Hashes(), table.value
        for b in batches:
            found = []
            for t in b.column(0):
                ws = words_of(t.as_py())
                for n in lengths:
                    h = shingle_hashes(ws, n, known)
                    found.append(h[_may_be(bits, h)])
            values, counts = np.unique(np.concatenate(found), return_counts=True) if found else ([], [])
            if len(values):
                yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts.astype(np.int64))], ["h", "n"])

    return docs.select(F.col(text).alias("text")).mapInArrow(run, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))


def _places(docs: DataFrame, doc: str, text: str, lengths: list[int], window: int, table) -> DataFrame:
    """(doc, ta, tb, n_words, at): every document, with its places of prefix shingles and the words around."""
    kind = docs.schema[doc].dataType
    at_type = pa.list_(pa.struct([("h", pa.int64()), ("pos", pa.int32()), ("before", pa.int32()), ("around", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, bits = Hashes(), table.value
        for b in batches:
            n_words, at = [], []
            for t in b.column("text"):
                ws = words_of(t.as_py())
                found = []
                for n in lengths:
                    h = shingle_hashes(ws, n, known)
                    for p in np.flatnonzero(_may_be(bits, h)).tolist():
                        lo = max(0, p - window + 1)
                        found.append((int(h[p:p + 1].view(np.int64)[0]), p, p - lo, b" ".join(ws[lo:p + window]).decode()))
                n_words.append(len(ws))
                at.append([dict(zip(("h", "pos", "before", "around"), x, strict=True)) for x in found])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc"), b.column("ta"), b.column("tb"), pa.array(n_words, pa.int64()), pa.array(at, at_type)],
                ["doc", "ta", "tb", "n_words", "at"])

    th = text_key(text)
    rows = docs.select(F.col(doc).alias("doc"), th["a"].alias("ta"), th["b"].alias("tb"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc {kind.simpleString()}, ta bigint, tb bigint, n_words bigint, "
                                "at array<struct<h:bigint,pos:int,before:int,around:string>>")


def contamination(docs: DataFrame, bench: DataFrame, doc: str = "doc_id", text: str = "text", item: str = "item_id",
                  item_text: str = "text", window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """(doc, ta, tb, n_words, n_hit, items) for every row of ``docs``.

    ``n_hit`` counts the words inside any occurrence of an item's window, ``items`` are the
    ids of the items with an occurring window.  A window is ``window`` consecutive words
    of an item, or the whole item if it has fewer; an item or text without words, null
    ones too, has none.  Repeated rows come out as often as they come in.  Items without
    an id count as hits but have no id to list.
    """
    spark = docs.sparkSession
    windows = cut(_windows(bench, item, item_text, window, shingle))
    lengths = sorted(r[0] for r in windows.select(F.least("k", F.lit(shingle))).distinct().collect())  # 1 to shingle
    table = spark.sparkContext.broadcast(_table(windows))
    counts = _corpus_counts(docs, text, lengths, table)
    # The necessary prefix of a window: its rarest shingle.  A shingle that no document has rules its window out.
    shingles = windows.select("win", "words", "k", "o", "h").distinct().join(counts, "h", "left")
    rarest = Window.partitionBy("win").orderBy(F.coalesce("n", F.lit(0)), "h", "o")
    prefix = cut(shingles.withColumn("r", F.row_number().over(rarest)).where("r = 1 and n > 0")
                 .select("win", "words", "k", "o", "h"))
    table2 = spark.sparkContext.broadcast(_table(prefix))
    scan = cut(_places(docs, doc, text, lengths, window, table2))
    places = scan.select("doc", "ta", "tb", F.inline("at"))
    joined = places.join(prefix, "h")
    bounded = joined.where((F.col("before") >= F.col("o"))
                           & (F.size(F.split("around", " ")) - F.col("before") + F.col("o") >= F.col("k")))
    window_words = F.array_join(F.slice(F.split("around", " "), F.col("before") - F.col("o") + 1, F.col("k")), " ")
    found = cut(bounded.where(window_words == F.col("words"))
                .select("doc", "ta", "tb", (F.col("pos") - F.col("o")).alias("start"), "k", "win").distinct())
    row = ["doc", "ta", "tb"]
    # Union of the occurrences' words; they are at most as many as the document's words.
    spans = F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("k")).alias("end"))))
    hit = F.aggregate(spans, F.struct(F.lit(0).alias("reach"), F.lit(0).alias("n")), lambda acc, x: F.struct(
        F.greatest(acc["reach"], x["end"]).alias("reach"),
        (acc["n"] + F.greatest(x["end"] - F.greatest(x["start"], acc["reach"]), F.lit(0))).alias("n")), lambda acc: acc["n"])
    hits = found.groupBy(*row).agg(hit.cast("long").alias("n_hit"))
    owners = windows.select("win", "item").distinct()
    items = found.select(*row, "win").distinct().join(owners, "win").groupBy(*row).agg(F.collect_set("item").alias("items"))
    out = _with(scan.drop("at"), _with(hits, items, row), row)
    kind = f"array<{bench.schema[item].dataType.simpleString()}>"
    return out.select(*row, "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                      F.coalesce("items", F.array().cast(kind)).alias("items"))


def _with(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on keys that may be null."""
    other = right.select(*[F.col(c).alias(f"_{c}") for c in keys], *[c for c in right.columns if c not in keys])
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys]
    return left.join(other, on, "left").drop(*[f"_{c}" for c in keys])


def contaminated(share: int = 20):
    """At least one word in ``share`` stands in a benchmark window."""
    return (F.col("n_hit") > 0) & (F.lit(share) * F.col("n_hit") >= F.col("n_words"))


def drop_contaminated(docs: DataFrame, bench: DataFrame, doc: str = "doc_id", text: str = "text",
                      item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents' rows that are not contaminated."""
    bad = contamination(docs, bench, doc, text, item, item_text).where(contaminated()).select("doc", "ta", "tb").distinct()
    rows = docs.select(F.struct("*").alias("row"))
    th = text_key(F.col("row")[text])
    rows = rows.select("row", F.col("row")[doc].alias("id"), th["a"].alias("xa"), th["b"].alias("xb"))
    return rows.join(bad, F.col("id").eqNullSafe(F.col("doc")) & (F.col("xa") == F.col("ta")) & (F.col("xb") == F.col("tb")),
                     "left_anti").select("row.*")
