"""Exact substring dedup by a sparse, distributed suffix array.

Which suffixes can matter: every string of ``length`` bytes has a minimizer, its 16-byte
substring with the smallest hash, and equal strings have equal minimizers.  A run of
neighbouring strings with one minimizer is a *stretch*.  A first pass finds the
minimizers that more than one document has; only hashes and document ids travel, packed.

The suffixes: stretches of repeated minimizers are range-partitioned by the 16 leading
bytes of their minimizer's suffix (Spark samples the splitters).  Each bucket sorts its
rows by those bytes with a multikey quicksort whose characters are 8-byte words, then
expands the stretches that differ inside a group into their suffixes, sorts these
likewise, and compares neighbours over ``length`` bytes.  A bucket's first and last group
may go on in the next bucket; their suffixes are compared across boundaries by digest.

Texts are shuffled once, compressed, and each distinct text is looked at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog_lake.llm.common import cut, text_key, written
from catalog_lake.llm.repeats import code_of, distinct_texts, identify, persist_in_place, repeated, unpack

LENGTH = 50
GRAM = 16
#: Suffixes that a bucket sorts together, unless one group alone has more.
SUFFIXES = 400_000
#: Rows that the multikey quicksort no longer splits around a pivot.
SMALL = 1 << 14
_U = np.uint64


def gram_hashes(b: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of every run of ``n`` bytes, put together from runs of powers of two."""
    def join(a: np.ndarray, c: np.ndarray, off: int) -> np.ndarray:
        m = len(c) - off
        h = (a[:m] * _U(0xBF58476D1CE4E5B9)) ^ c[off:]
        h ^= h >> _U(29)
        return h * _U(0x94D049BB133111EB)

    power, size = (b.astype(np.uint64) + _U(1)) * _U(0x9E3779B97F4A7C15), 1
    out, have = None, 0
    while n:
        if n & 1:
            out, have = (power, size) if out is None else (join(out, power, have), have + size)
        n >>= 1
        if n:
            power, size = join(power, power, size), 2 * size
    return out


def _slide_min(a: np.ndarray, w: int) -> np.ndarray:
    size = 1
    while 2 * size <= w:
        a, size = np.minimum(a[:-size], a[size:]), 2 * size
    return np.minimum(a[:len(a) - (w - size)], a[w - size:]) if w > size else a


def stretches(text: bytes, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first start, end start, minimizer hash, hash of every gram) of the runs of strings with one minimizer."""
    if len(text) < length:
        return (np.empty(0, np.int64),) * 2 + (np.empty(0, np.uint64),) * 2
    grams = gram_hashes(np.frombuffer(text, np.uint8), gram)
    low = _slide_min(grams, length - gram + 1)
    first = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
    return first, np.append(first[1:], len(low)), low[first], grams


def _sort_small(words: list[np.ndarray], rows: np.ndarray, rank: np.ndarray) -> None:
    """Rank the few ``rows`` among themselves, a word at a time; ``rank`` holds what they start from."""
    for word in words:
        if not len(rows):
            return
        sub = rows[np.lexsort((word[rows], rank[rows]))]
        r, w = rank[sub], word[sub]
        new_run = np.concatenate([[True], r[1:] != r[:-1]])
        runs = np.flatnonzero(new_run | np.concatenate([[True], w[1:] != w[:-1]]))
        begin = np.maximum.accumulate(np.where(new_run, np.arange(len(sub)), 0))
        size = np.diff(np.append(runs, len(sub)))
        rank[sub] = r + np.repeat(runs, size) - begin  # the old run's rank and the rows before it in that run
        rows = sub[np.repeat(size, size) > 1]


def multikey_sort(words: list[np.ndarray], small: int = SMALL) -> np.ndarray:
    """Each row's rank: how many rows have smaller words.  Equal rows share a rank.

    Multikey quicksort with an 8-byte word as character: a run of rows is split around a
    pivot word into smaller, equal and larger ones; only the equal ones go on to the next
    word.  Runs of at most ``small`` rows are sorted at once.
    """
    rank = np.zeros(len(words[0]), np.int64)
    runs = [(np.arange(len(rank)), 0)]
    while runs:
        rows, k = runs.pop()
        if k == len(words) or len(rows) < 2:
            continue
        if len(rows) <= small:
            _sort_small(words[k:], rows, rank)
            continue
        w = words[k][rows]
        pivot = np.sort(w[np.linspace(0, len(w) - 1, 9).astype(int)])[4]
        less, same, more = rows[w < pivot], rows[w == pivot], rows[w > pivot]
        rank[same] += len(less)
        rank[more] += len(less) + len(same)
        runs += [(less, k), (same, k + 1), (more, k)]
    return rank


def _suffixes(texts: DataFrame, repeats: DataFrame, length: int, gram: int) -> DataFrame:
    """(w1, w2, doc, v, start, s): stretches of repeated minimizers with the first bytes of the minimizer."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [[] for _ in range(6)]
            cols = [b.column(c).to_pylist() for c in ("doc", "v", "bits")]
            for d, v, bits, codes, t in zip(*cols, b.column("codes"), unpack(b.column("z")), strict=True):
                first, end, low, grams = stretches(t, length, gram)
                if not len(first):
                    continue
                hit = np.isin(code_of(low, bits), codes.values.to_numpy())
                first, end, low = first[hit], end[hit], low[hit]
                if not len(first):
                    continue
                view = np.lib.stride_tricks.sliding_window_view(grams, length - gram + 1)
                at = first + np.argmax(view[first] == low[:, None], axis=1)
                raw = np.frombuffer(t + b"\0" * 16, np.uint8)
                lead = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(raw, 16)[at]).view(">u8")
                signed = (lead.astype(np.uint64) ^ _U(1 << 63)).view(np.int64).reshape(-1, 2)
                out[0].append(signed[:, 0])
                out[1].append(signed[:, 1])
                out[2].append(np.full(len(first), d, np.int64))
                out[3].append(np.full(len(first), v, np.int32))
                out[4].append(first.astype(np.int32))
                out[5] += [t[i:j + length - 1] for i, j in zip(first.tolist(), end.tolist(), strict=True)]
            if out[5]:
                yield pa.RecordBatch.from_arrays([*[pa.array(np.concatenate(c)) for c in out[:5]], pa.array(out[5], pa.binary())],
                                                 ["w1", "w2", "doc", "v", "start", "s"])

    return texts.join(repeats, "doc").mapInArrow(run, "w1 bigint, w2 bigint, doc bigint, v int, start int, s binary")


def _windows(s: list[bytes], rows: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, bytes padded to whole words) of every string of ``length`` bytes in the stretches ``rows``."""
    size = np.array([len(s[i]) for i in rows])
    raw = np.frombuffer(b"".join([s[i] for i in rows]), np.uint8)
    count = size - length + 1
    row = np.repeat(np.arange(len(rows)), count)
    place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    begin = (np.cumsum(size) - size)[row] + place
    out = np.zeros((len(row), -(-length // 8) * 8), np.uint8)
    out[:, :length] = np.lib.stride_tricks.sliding_window_view(raw, length)[begin] if len(row) else 0
    return rows[row], place, out


def _compare(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Spans found in this bucket (a, b null), and the suffixes of its outer groups with their digests."""
    table = [b for b in batches if b.num_rows]
    if not table:
        return
    w1, w2, doc, v, start = (np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in table])
                             for c in ("w1", "w2", "doc", "v", "start"))
    s = [x for b in table for x in b.column("s").to_pylist()]
    del table
    group = multikey_sort([w1, w2])
    digest = np.array([xxhash.xxh3_64_intdigest(x) for x in s], np.uint64)
    digest2 = np.array([xxhash.xxh64_intdigest(x) for x in s], np.uint64)
    order = np.lexsort((doc, digest2, digest, group))
    g, a, b, d = group[order], digest[order], digest2[order], doc[order]
    new_g = np.concatenate([[True], g[1:] != g[:-1]])
    new_s = new_g | np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    first = np.flatnonzero(new_s)
    least = d[first][np.cumsum(new_s) - 1]
    gi = np.cumsum(new_g) - 1
    heads = np.flatnonzero(new_g)
    mixed = (np.add.reduceat(new_s.astype(np.int64), heads) > 1) & (np.minimum.reduceat(d, heads) < np.maximum.reduceat(d, heads))
    outer = np.zeros(len(heads), bool)
    outer[0] = outer[-1] = True  # ranks follow the leading bytes, so these are the bucket's ends
    whole = d > least  # an equal stretch starts in a smaller document
    size = np.array([len(x) for x in s])

    def spans(rows: np.ndarray, begin: np.ndarray, end: np.ndarray, a=None, b=None) -> pa.RecordBatch:
        none = pa.nulls(len(rows), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(doc[rows]), pa.array(v[rows]), pa.array((start[rows] + begin).astype(np.int32)),
             pa.array((start[rows] + end).astype(np.int32)), none if a is None else pa.array(a), none if b is None else pa.array(b)],
            ["doc", "v", "start", "end", "a", "b"])

    rows = order[whole]
    yield spans(rows, np.zeros(len(rows), np.int64), size[rows])
    for ends in (False, True):
        pick = ~whole & (outer[gi] if ends else (mixed & ~outer)[gi])
        todo, todo_group = order[pick], gi[pick]
        if not len(todo):
            continue
        n = np.cumsum(size[todo] - length + 1)
        begins = np.flatnonzero(np.concatenate([[True], todo_group[1:] != todo_group[:-1]]))
        at = 0
        while at < len(todo):  # whole groups, up to SUFFIXES at a time
            limit = (n[at - 1] if at else 0) + SUFFIXES
            fits = begins[(begins > at) & (n[begins - 1] <= limit)]
            later = begins[begins > at]
            to = int(fits[-1]) if len(fits) else int(later[0]) if len(later) else len(todo)
            if n[-1] <= limit:
                to = len(todo)
            row, place, raw = _windows(s, todo[at:to], length)
            at = to
            words = raw.view(">u8").astype(np.uint64)
            rank = multikey_sort([words[:, i] for i in range(words.shape[1])])
            by = np.lexsort((doc[row], rank))
            head = np.concatenate([[True], rank[by][1:] != rank[by][:-1]])
            low = doc[row][by][head][np.cumsum(head) - 1]
            found = np.zeros(len(row), bool)
            found[by] = doc[row][by] > low
            if ends:  # the bucket's smallest document of each string: a smaller one may be in the next bucket
                texts = [x.tobytes() for x in raw[~found, :length]]
                yield spans(row[~found], place[~found], place[~found] + length,
                            np.array([xxhash.xxh3_64_intdigest(x) for x in texts], np.uint64).view(np.int64),
                            np.array([xxhash.xxh64_intdigest(x) for x in texts], np.uint64).view(np.int64))
            row, place = row[found], place[found]
            if len(row):  # neighbouring strings of one stretch become one span
                begin = np.concatenate([[True], (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1)])
                last = np.append(np.flatnonzero(begin)[1:], len(row)) - 1
                yield spans(row[begin], place[begin], place[last] + length)


def _removed(batches: Iterator[pa.RecordBatch], with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for d, v, found, t in zip(batch.column("doc").to_pylist(), batch.column("v").to_pylist(), batch.column("spans").to_pylist(),
                                  unpack(batch.column("z")), strict=True):
            merged: list[list[int]] = []
            for x in sorted((x["start"], x["end"]) for x in found if x["v"] == v):
                if merged and x[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], x[1])
                else:
                    merged.append(list(x))
            kept, at = [], 0
            for i, j in merged:
                kept.append(t[at:i])
                at = j
            rest = b"".join([*kept, t[at:]])
            out.append((d, v, len(t) - len(rest), len(merged), hashlib.sha256(rest).hexdigest(), rest))
        names = ["doc", "v", "n_removed", "n_spans", "kept_sha256", *["kept"] * with_text]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        cols = list(zip(*out, strict=True)) if out else [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in list(zip(cols, types, strict=True))[:len(names)]], names)


def remove_repeats(docs: DataFrame, doc: str = "doc_id", text: str = "text", length: int = LENGTH, with_text: bool = False) -> DataFrame:
    """(doc, n_bytes, n_removed, n_spans, kept_sha256), and the kept bytes if asked, one row per input row.

    A byte goes if a string of ``length`` bytes over it also starts in a document with a
    smaller id; strings never cross documents and are judged on the input.  A null or
    empty text has no bytes.  Rows with one id never remove each other, so exact repeats
    of a row are treated alike; a row without an id neither loses bytes nor costs others
    any.  ``length`` must be at least 16 bytes.  Ids are integers.
    """
    gram = min(GRAM, length)
    reps = cut(identify(docs, doc, text))
    texts = persist_in_place(distinct_texts(docs, reps.select("doc", "v", "ta", "tb"), doc, text))
    repeats = cut(repeated(texts, lambda t: stretches(t, length, gram)[2]))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Written first: sampling the splitters would else make the suffixes a second time.
    with written(_suffixes(texts, repeats, length, gram), "suffixes") as suffixes:
        found = cut(suffixes.repartitionByRange(n, "w1", "w2", "doc").mapInArrow(
            lambda it: _compare(it, length), "doc bigint, v int, start int, end int, a bigint, b bigint"))
    here = found.where("a is null").select("doc", "v", "start", "end")
    ends = found.where("a is not null")
    low = ends.groupBy("a", "b").agg(F.min("doc").alias("low"))
    across = ends.join(low, ["a", "b"]).where(F.col("doc") > F.col("low")).select("doc", "v", "start", "end")
    spans = here.unionAll(across).groupBy("doc").agg(F.collect_list(F.struct("v", "start", "end")).alias("spans"))
    gone = cut(texts.join(spans, "doc").mapInArrow(
        lambda it: _removed(it, with_text),
        "doc bigint, v int, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept binary" * with_text))
    texts.unpersist()
    # Back to rows: the first row of a text has its result; later copies of it lose everything.
    of_text = reps.join(gone, ["doc", "v"], "left").withColumnRenamed("doc", "rep").drop("v", "n")
    th, t = text_key("text"), F.coalesce(F.col("text"), F.lit(""))
    raw = docs.select(F.col(doc).alias("doc"), F.col(text).alias("text"))
    rows = raw.select("doc", th["a"].alias("ta"), th["b"].alias("tb"), F.octet_length(t).cast("long").alias("n_bytes"),
                      F.sha2(t.cast("binary"), 256).alias("sha"), *[t.cast("binary").alias("bytes")] * with_text)
    rows = rows.join(of_text, ["ta", "tb"], "left")
    copy = (F.col("doc") > F.col("rep")) & (F.col("n_bytes") >= length)
    cut_here = (F.col("doc") == F.col("rep")) & F.col("n_removed").isNotNull()
    pick = lambda all_gone, some, none: F.when(copy, all_gone).when(cut_here, some).otherwise(none)
    out = [pick(F.col("n_bytes"), F.col("n_removed"), F.lit(0)).cast("long").alias("n_removed"),
           pick(F.lit(1), F.col("n_spans"), F.lit(0)).cast("long").alias("n_spans"),
           pick(F.sha2(F.lit("").cast("binary"), 256), F.col("kept_sha256"), F.col("sha")).alias("kept_sha256")]
    if with_text:
        out.append(pick(F.lit("").cast("binary"), F.col("kept"), F.col("bytes")).alias("kept"))
    return rows.select("doc", "n_bytes", *out)
