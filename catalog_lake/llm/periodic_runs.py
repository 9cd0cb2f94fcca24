"""Periodic runs: stretches of words that repeat themselves, found online on sparse diagonals.

The words are read once.  For each word its earlier occurrences are matches on the
diagonals of their lags (place minus earlier place).  A diagonal is active while its words
keep matching; when it ends, its length says at once whether it was a run.

Two rules keep the diagonals sparse without losing a run.  A run of period q with exponent
4 matches at 3q places in a row, so among them is a multiple of the largest power of two
that 3q reaches; a lag is opened at such places alone and followed back to where its
matches began.  So any n words, equal ones too, look at no more than about n log2(n) / 3
earlier occurrences.  And a multiple of an active lag is not opened inside the active
stretch: there both have the same start and end, and the smaller is the period.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: A run has this many words at least, and its period this many times.
LEAST_WORDS, LEAST_TIMES = 6, 4


def find_runs(words: list[str]) -> list[tuple[int, int, int]]:
    """(start, length, period) of every maximal run, by start, then period.

    A run is a stretch with smallest period q and length >= max(6, 4 q) that no word beside
    it extends.
    """
    index: dict[str, int] = {}
    w = [index.setdefault(x, len(index)) for x in words]
    seen: list[list[int]] = [[] for _ in index]
    active: dict[int, int] = {}  # lag -> start of its stretch
    runs: dict[tuple[int, int], int] = {}

    def end(lag: int, stop: int) -> None:
        start = active.pop(lag)
        if stop - start >= max(LEAST_WORDS, LEAST_TIMES * lag):
            extent = (start, stop - start)
            runs[extent] = min(lag, runs.get(extent, lag))

    for i, word in enumerate(w):
        if active:
            for lag in [lag for lag in active if w[i - lag] != word]:
                end(lag, i)
        if i & 1 == 0:
            reach = i - min((2 * (i & -i) - 1) // 3, len(w) // LEAST_TIMES)
            # Only a stretch of two periods and a word holds a multiple's match.
            repeating = [(lag, start) for lag, start in active.items() if i - start >= 2 * lag]
            for j in reversed(seen[word]):
                if j < reach:
                    break
                lag = i - j
                if lag in active or repeating and any(lag % q == 0 and j >= start for q, start in repeating):
                    continue
                k = i - 1
                while k >= lag and w[k] == w[k - lag]:
                    k -= 1
                active[lag] = start = k + 1 - lag
                if i - start >= 2 * lag:
                    repeating.append((lag, start))
        seen[word].append(i)
    for lag in list(active):
        end(lag, len(w))
    return sorted((start, length, q) for (start, length), q in runs.items())


def collapse(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """The words that no run holds after its first period."""
    kept, at = [], 0
    # Ranges by start + period, merged from left to right.
    for first, stop in sorted((s + q, s + length) for s, length, q in runs):
        if first > at:
            kept += words[at:first]
        at = max(at, stop)
    return kept + words[at:]


def looped(words: list[str], doc_id: int) -> list[str]:
    """The words of one document in ten, chosen by the checksum of its id, with a part of them repeated to the end."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def periodic_runs(docs: DataFrame, doc: str = "doc_id", text: str = "text", with_loops: bool = False,
                  with_spans: bool = False) -> DataFrame:
    """(doc, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) and, if asked, runs and collapsed.

    ``start`` to ``exponent_milli`` tell of the longest run (ties: smallest start, then
    period), null without runs.  ``runs`` lists (start, length, period), ``collapsed`` is
    the text's words without the repeated ones.  Words are parted by the six ASCII blanks.
    ``with_loops`` first loops the documents that ``looped`` chooses; ids must then be
    whole numbers, and a null id is never chosen.  A null, empty or blank text has no words
    and no runs.  One row per input row, nothing is shuffled; repeated rows give repeated
    rows, an empty table none.
    """
    kind = docs.schema[doc].dataType.simpleString()
    fields = ["n_runs bigint", "start bigint", "length bigint", "period bigint", "exponent_milli bigint",
              "runs_sha256 string", "collapsed_sha256 string"]
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    types = [*[pa.int64()] * 5, pa.string(), pa.string()]
    if with_spans:
        fields += ["runs array<struct<start:bigint,length:bigint,period:bigint>>", "collapsed string"]
        types += [span_type, pa.string()]
    names = ["doc", *[f.split()[0] for f in fields]]

    def row(d: int | None, t: str | None) -> tuple:
        words = WORD.findall(t or "")
        if with_loops and d is not None:
            words = looped(words, d)
        runs = find_runs(words)
        kept = " ".join(collapse(words, runs))
        start, length, q = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
        out = (len(runs), start, length, q, 1000 * length // q if q else None,
               hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())
        return (*out, [{"start": s, "length": n, "period": p} for s, n, p in runs], kept) if with_spans else out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1)
            rows = [row(d, texts[k].as_py()) for k, d in enumerate(b.column(0).to_pylist())]
            cols = list(zip(*rows, strict=True)) if rows else [[]] * len(types)
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, t) for c, t in zip(cols, types, strict=True)]], names)

    return docs.select(F.col(doc).alias("doc"), F.col(text).alias("text")).mapInArrow(run, f"doc {kind}, " + ", ".join(fields))
