"""Toxicity by a classifier chain of linear models.

Categories are predicted one after another.  Each model is a logistic regression on the
presence of words and of their beginnings, all of them, by their hashes, and on the
probabilities of the categories before it.  So that a later model learns from honest
probabilities, its training rows get them out of fold: from models that were fitted
without the row.  Out-of-fold rows also choose each category's threshold.

Every labelled row counts in every fit.  Up to ``TASK_ROWS`` of them, the fits are numpy in
Spark tasks, one per fold and one for all rows, side by side.  More rows are fitted where they
are, in blocks of ``TASK_ROWS`` / 3 rows of one fold or up to twice as many, and a model is the mean of
its blocks' fits, weighted by their rows (Zhang, Duchi and Wainwright 2012): of all blocks, or of
those outside a fold.  The L1 penalty leaves few terms with a weight, so scoring a document is a
look at each of its distinct words.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from catalog_lake.llm.common import cut, written
from catalog_lake.llm.repeats import unpack

#: Up to so many labelled rows each model is fitted in one task; more are fitted in blocks of at most so many.
TASK_ROWS = 8_000
FOLDS = 3
#: Lengths of the beginnings of longer words that are features besides the words.
BEGINNINGS = (3, 4, 5, 6)
#: Bytes of text (packed or not) whose words are hashed at once, and the longest word, in bytes, that is hashed beside others.
CHUNK = 1 << 20
LONG_WORD = 40
#: L1 penalty of the mean loss, chosen on held-out rows of ``labels``.
PENALTY = 0.0004
#: The thresholds that out-of-fold rows choose from.
THRESHOLDS = tuple(k / 20 for k in range(1, 20))


@dataclass(frozen=True)
class Linear:
    """Intercept, weights of the terms (by hash) and of the categories before."""

    intercept: float
    terms: dict[int, float]
    before: tuple[float, ...]


@dataclass(frozen=True)
class Chain:
    """A fitted chain: (category, model) in the order of prediction, and each category's threshold."""

    models: tuple[tuple[str, Linear], ...]
    thresholds: dict[str, float]

    def flagged(self, category: str) -> Column:
        return F.col(f"p_{category}") >= self.thresholds[category]


WORD = re.compile(r"[^\W_]+")
_ASCII = bytes(range(128))
#: ASCII that is not of a word becomes a blank; bytes of longer characters stay.
_BLANKED = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))
#: The table of CRC-32 by the low byte of its state.
_CRC = np.array([zlib.crc32(bytes([c]), 0xFFFFFFFF) ^ 0xFFFFFFFF for c in range(256)], np.uint32)


def _blanked(text: str) -> bytes:
    """The text in lower case, its words (``WORD``) parted by blanks only."""
    low = text.lower()
    raw = low.encode()
    if not raw.isascii():
        others = [c for c in set(raw.translate(None, _ASCII).decode()) if not c.isalnum()]
        if len(others) > 20:
            return " ".join(WORD.findall(low)).encode()
        for c in others:
            raw = raw.replace(c.encode(), b" ")
    return raw.translate(_BLANKED)


def _crc_step(state: np.ndarray, byte: np.ndarray) -> np.ndarray:
    return _CRC.take((state ^ byte) & 0xFF) ^ (state >> 8)


def _word_terms(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of all words of the texts and of the beginnings they are longer than, repeats included.

    The CRC-32 of all words at once, byte by byte; the words lie from the longest to the
    shortest, so those that have a byte are the first ones.
    """
    raws = [_blanked(t) + b" " for t in texts]
    data = np.frombuffer(b"".join(raws), np.uint8)
    inside = np.concatenate([[False], data != 32])
    start = np.flatnonzero(inside[1:] & ~inside[:-1])
    length = np.flatnonzero(inside[:-1] & ~inside[1:]) - start
    order = np.argsort(-np.minimum(length, LONG_WORD + 1).astype(np.int16), kind="stable")
    row = np.searchsorted(np.cumsum([len(r) for r in raws]), start, side="right")[order]
    start, length = start[order], length[order]
    state = np.full(len(start), 0xFFFFFFFF, np.uint32)
    long = int((length > LONG_WORD).sum())
    for j in range(LONG_WORD):
        m = int((length > j).sum())
        if m <= long:
            break
        state[long:m] = _crc_step(state[long:m], data.take(start[long:m] + j))
    codes = [state ^ np.uint32(0xFFFFFFFF)]
    for k in range(long):
        codes[0][k] = zlib.crc32(data[start[k]:start[k] + length[k]])
    rows = [row]
    state, whole = np.full(len(start), zlib.crc32(b"^") ^ 0xFFFFFFFF, np.uint32), np.zeros(len(start), np.int8)
    for j in range(4 * BEGINNINGS[-1]):  # a character has at most four bytes
        m = int((length > j + 1).sum())
        if not m:
            break
        state, start, length, row = _crc_step(state[:m], data.take(start[:m] + j)), start[:m], length[:m], row[:m]
        ends = data.take(start + (j + 1)) & 0xC0 != 0x80  # the next byte begins a character
        whole = whole[:m] + ends
        hit = ends & np.isin(whole, BEGINNINGS)
        codes.append(state[hit] ^ np.uint32(0xFFFFFFFF))
        rows.append(row[hit])
        if (on := whole < BEGINNINGS[-1]).sum() < m:
            state, start, length, row, whole = state[on], start[on], length[on], row[on], whole[on]
    return np.concatenate(rows), np.concatenate(codes)


def _distinct(row: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Each pair once and in order, as row * 2^32 + code."""
    pairs = np.sort(row << 32 | code)
    return pairs[np.concatenate([[True], pairs[1:] != pairs[:-1]])[:len(pairs)]]


def _chunks(sizes: Sequence[int]) -> Iterator[slice]:
    """Runs of texts of about ``CHUNK`` bytes, by their sizes; a longer text is one of its own."""
    first, total = 0, 0
    for k, n in enumerate(sizes):
        if total and total + n > CHUNK:
            yield slice(first, k)
            first, total = k, 0
        total += n
    if first < len(sizes):
        yield slice(first, len(sizes))


def terms(text: str | None) -> set[int]:
    """Hashes of the lower-case words of the whole text and of their beginnings."""
    return set(_word_terms([text or ""])[1].tolist())


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last column's texts compressed, for a join that shuffles them."""
    z = zstandard.ZstdCompressor(level=3)
    for b in batches:
        packed = pa.array([z.compress(t.as_buffer() if t.is_valid else b"") for t in b.column(b.num_columns - 1)], pa.binary())
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], packed], b.schema.names)


def _hash_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last column's packed texts as their terms."""
    for b in batches:
        packed = b.column(b.num_columns - 1)
        for part in _chunks([len(z.as_buffer()) for z in packed]):
            texts = [x.decode() for x in unpack(packed[part])]
            found = _distinct(*_word_terms(texts))
            ends = np.searchsorted(found, np.arange(len(texts) + 1) << 32).astype(np.int32)
            hashes = pa.ListArray.from_arrays(pa.array(ends), pa.array(found & 0xFFFFFFFF))
            yield pa.RecordBatch.from_arrays([*[c[part] for c in b.columns[:-1]], hashes], [*b.schema.names[:-1], "_hashes"])


# --- fitting --------------------------------------------------------------------------------

def _sums(values: np.ndarray, rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The sum of the rows' values from each start to the next."""
    return np.add.reduceat(values.take(rows, mode="clip"), starts) if len(starts) else np.zeros(0)


def fit_linear(codes: np.ndarray, lengths: np.ndarray, before: np.ndarray, y: np.ndarray, penalty: float = PENALTY,
               rounds: int = 100, close: float = 1e-3) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """(intercept, terms, weights, weights of ``before``) that minimise mean log loss + penalty * sum of absolute weights.

    ``codes`` are the rows' terms one row after the other, ``lengths`` of them each.  A term
    in at most penalty * n rows cannot get a weight, whatever the others'; the rest is
    solved on a working set that grows until no term outside it wants in.  Accelerated
    proximal steps with a bound of the curvature per weight.
    """
    n = len(y)
    if not n or y.min() == y.max():
        share = float(y[0]) if n else 0.0
        return (30.0 if share else -30.0), np.zeros(0, np.int64), np.zeros(0), np.zeros(before.shape[1])
    # The rows of each term side by side, so that a sum over a term's rows is one over a range.
    order = np.argsort(codes)
    ordered = codes[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])[:len(ordered)])
    count = np.diff(np.append(first, len(ordered)))
    common = count > penalty * n
    row = np.repeat(np.arange(n), lengths)[order[np.repeat(common, count)]]
    names, count = ordered[first[common]], count[common]
    del order, ordered
    first = np.cumsum(count) - count
    w, wb, b = np.zeros(len(names)), np.zeros(before.shape[1]), float(np.log(y.mean() / (1 - y.mean())))
    margin, inside = np.full(n, b), np.zeros(len(names), bool)
    for _ in range(20):
        rest = 1 / (1 + np.exp(-margin)) - y
        slope = _sums(rest, row, first) / n
        wants = ~inside & (np.abs(slope) > 1.02 * penalty)
        if not wants.any() and inside.any():
            break
        inside |= wants
        r, size, k = row[np.repeat(inside, count)], count[inside], int(inside.sum())
        start = np.cumsum(size) - size
        per_row = np.bincount(r, minlength=n) + 1 + np.abs(before).sum(axis=1)
        curve = np.concatenate([_sums(per_row, r, start), (np.abs(before) * per_row[:, None]).sum(axis=0) + 1e-9, [per_row.sum()]]) / (4 * n)
        x = np.concatenate([w[inside], wb, [b]])
        at, speed = x.copy(), 1.0
        for _ in range(rounds):
            margin = np.bincount(r, np.repeat(at[:k], size), n) + before @ at[k:-1] + at[-1]
            rest = (1 / (1 + np.exp(-margin)) - y) / n
            g = np.concatenate([_sums(rest, r, start), before.T @ rest, [rest.sum()]])
            new = at - g / curve
            new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - penalty / curve[:-1], 0)
            faster = (1 + np.sqrt(1 + 4 * speed ** 2)) / 2
            if (at - new) @ (new - x) > 0:  # overshot: start the acceleration anew
                faster, speed = 1.0, 1.0
            at = new + (speed - 1) / faster * (new - x)
            moved, x, speed = np.abs(new - x).max(), new, faster
            if moved < close:
                break
        w[inside], wb, b = x[:k], x[k:-1], float(x[-1])
        margin = np.bincount(r, np.repeat(x[:k], size), n) + before @ wb + b
    used = w != 0
    return b, names[used], w[used], wb


def _fit_part(n_before: int, folds: int, penalty: float):
    """A group's fit: weights for all rows, or for the rows outside a fold and the probabilities of those in it."""
    schema = pa.schema([("part", pa.int32()), ("row", pa.int64()), ("p", pa.float64()), ("term", pa.int64()), ("weight", pa.float64()), ("kind", pa.string())])

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        part = rows.column("part")[0].as_py()
        hashes = rows.column("hashes").combine_chunks()
        codes, lengths = hashes.flatten().to_numpy(), np.diff(hashes.offsets.to_numpy())
        y = rows.column("y").to_numpy()
        before = np.array(rows.column("before").to_pylist(), float).reshape(len(y), n_before)
        inside = rows.column("fold").to_numpy() != part
        mine = np.repeat(inside, lengths)
        b, names, w, wb = fit_linear(codes[mine], lengths[inside], before[inside], y[inside], penalty)
        if part == folds:
            out = [(part, None, None, None, b, "intercept"), *[(part, None, None, k, v, "before") for k, v in enumerate(wb.tolist())],
                   *[(part, None, None, t, v, "term") for t, v in zip(names.tolist(), w.tolist(), strict=True)]]
        else:
            at = np.minimum(np.searchsorted(names, codes[~mine]), max(len(names) - 1, 0))
            hit = names[at] == codes[~mine] if len(names) else np.zeros(len(at), bool)
            held = np.repeat(np.arange(int((~inside).sum())), lengths[~inside])
            margin = np.bincount(held[hit], w[at[hit]] if len(names) else None, int((~inside).sum())) + before[~inside] @ wb + b
            p = 1 / (1 + np.exp(-margin))
            out = [(part, r, v, None, None, "held") for r, v in zip(rows.column("row").to_numpy()[~inside].tolist(), p.tolist(), strict=True)]
        cols = list(zip(*out, strict=True)) if out else [[]] * 6
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    return run


# --- fitting of more rows than one task takes -------------------------------------------------

def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values one list after the other, the row of each)."""
    return lists.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))


class _HeldOut:
    """Probabilities of rows by the models fitted outside their folds, category after category."""

    def __init__(self, models: Sequence[Sequence[Linear]]):
        self.models = [[(m.intercept, names := np.array(sorted(m.terms), np.int64), np.array([m.terms[t] for t in names.tolist()]), np.array(m.before, float))
                        for m in of[:-1]] for of in models]

    def __call__(self, b: pa.RecordBatch) -> np.ndarray:
        fold, p = b.column("_fold").to_numpy(), np.zeros((b.num_rows, len(self.models)))
        codes, row = _flat(b.column("_hashes"))
        for i, of in enumerate(self.models):
            for k, (intercept, names, weights, before) in enumerate(of):
                mine = fold == k
                if not mine.any():
                    continue
                margin = intercept + p[:, :i] @ before
                if len(names):
                    inside = np.flatnonzero(mine[row])
                    at = np.minimum(np.searchsorted(names, codes[inside]), len(names) - 1)
                    hit = names[at] == codes[inside]
                    margin = margin + np.bincount(row[inside[hit]], weights[at[hit]], b.num_rows)
                p[mine, i] = 1 / (1 + np.exp(-margin[mine]))
        return p


def _fit_blocks(rows: DataFrame, n: int, category: str, earlier: Sequence[Sequence[Linear]], block: int, penalty: float) -> DataFrame:
    """(n, kind, term, weight): the fits of blocks of ``block`` to twice as many of the ``n`` rows, where these are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, ...]] = []
        held_out = _HeldOut(earlier)

        def fit() -> pa.RecordBatch:
            codes, lengths, x, y = (np.concatenate(c) for c in zip(*kept, strict=True))
            kept.clear()
            b, names, w, wb = fit_linear(codes, lengths, x, y, penalty)
            if y.min() == y.max():  # no finite fit: the odds of so many rows
                b = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
            out = [("intercept", None, b), *[("before", k, v) for k, v in enumerate(wb.tolist())],
                   *[("term", t, v) for t, v in zip(names.tolist(), w.tolist(), strict=True)]]
            kind, term, weight = zip(*out, strict=True)
            return pa.RecordBatch.from_arrays([pa.array([len(y)] * len(out), pa.int64()), pa.array(kind), pa.array(term, pa.int64()), pa.array(weight, pa.float64())],
                                              ["n", "kind", "term", "weight"])

        for batch in batches:
            for at in range(0, batch.num_rows, min(block, 500)):
                b = batch.slice(at, min(block, 500))
                kept.append((_flat(b.column("_hashes"))[0].astype(np.uint32), np.diff(b.column("_hashes").offsets.to_numpy()), held_out(b),
                             b.column(category).to_numpy()))
                held = np.cumsum([len(k[3]) for k in kept])
                if held[-1] >= 2 * block:
                    enough = int(np.searchsorted(held, block)) + 1
                    rest = kept[enough:]
                    del kept[enough:]
                    yield fit()
                    kept[:] = rest
        if kept:
            yield fit()

    few = rows.select("_fold", "_hashes", category).coalesce(max(1, n // (block + block // 2)))
    return few.mapInArrow(run, "n bigint, kind string, term bigint, weight double")


def _fit_across_tasks(rows: DataFrame, category: str, earlier: Sequence[Sequence[Linear]], folds: int, penalty: float, block: int) -> list[Linear]:
    """The models for each fold, of the rows outside it, and last the one of all rows: means of the blocks' fits, weighted by rows."""
    sums = {r["_fold"]: (r["n"], r["y"]) for r in rows.groupBy("_fold").agg(F.count("*").alias("n"), F.sum(category).alias("y")).collect()}
    fitted = None
    for fold, (n, _) in sorted(sums.items()):
        part = _fit_blocks(rows.where(F.col("_fold") == fold), n, category, earlier, block, penalty).withColumn("fold", F.lit(fold))
        fitted = part if fitted is None else fitted.unionAll(part)
    means = cut(fitted).groupBy("kind", "term").agg(*[F.sum(F.when(F.col("fold") == k, F.col("n") * F.col("weight")).otherwise(0.0)).alias(f"s{k}")
                                                      for k in range(folds)]).collect()
    models = []
    for k in range(folds + 1):
        n, y = (sum(v[j] for fold, v in sums.items() if fold != k) for j in (0, 1))
        if not 0 < y < n:
            models.append(Linear(30.0 if n and y else -30.0, {}, (0.0,) * len(earlier)))
            continue
        mean = {(r["kind"], r["term"]): sum(r[f"s{j}"] for j in range(folds) if j != k) / n for r in means}
        models.append(Linear(mean[("intercept", None)], {t: w for (kind, t), w in mean.items() if kind == "term" and w},
                             tuple(mean[("before", j)] for j in range(len(earlier)))))
    return models


def _with_held_out(rows: DataFrame, models: Sequence[Sequence[Linear]], categories: Sequence[str]) -> DataFrame:
    """The rows without their terms, with every category's probability by the models of the rows outside the row's fold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_out = _HeldOut(models)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                b = batch.slice(at, 500)
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], *[pa.array(p) for p in held_out(b).T]],
                                                 [*b.schema.names[:-1], *[f"p_{c}" for c in categories]])

    schema = StructType(rows.schema.fields[:-1])
    for c in categories:
        schema = schema.add(f"p_{c}", "double")
    return rows.mapInArrow(run, schema)


def _fit_chain_across_tasks(rows: DataFrame, categories: Sequence[str], folds: int, penalty: float, block: int) -> tuple[Chain, DataFrame]:
    """The chain of a table of any size, and its training rows."""
    models: list[list[Linear]] = []
    for category in categories:
        models.append(_fit_across_tasks(rows, category, models, folds, penalty, block))
    # The rows are read after the folder of their terms is gone.
    held = cut(_with_held_out(rows, models, categories))
    return Chain(tuple((c, of[-1]) for c, of in zip(categories, models, strict=True)), {c: _threshold(held, c) for c in categories}), held


# --- the chain ------------------------------------------------------------------------------

def _threshold(rows: DataFrame, category: str) -> float:
    """The threshold with the best F1 of the category's probability; ties go to the one nearest a half."""
    y, p = F.col(category) == 1, F.col(f"p_{category}")
    sums = rows.agg(F.count_if(y).alias("n"), *[x for k, t in enumerate(THRESHOLDS) for x in (
        F.count_if(p >= t).alias(f"a{k}"), F.count_if(y & (p >= t)).alias(f"b{k}"))]).first()
    return max((2 * sums[f"b{k}"] / max(sums[f"a{k}"] + sums["n"], 1), -abs(t - 0.5), t) for k, t in enumerate(THRESHOLDS))[2]


def _labelled(texts: DataFrame, known: DataFrame) -> DataFrame:
    """The packed texts with a label; one join at all sizes, as a broadcast of few labels becomes a shuffle when they grow."""
    packed = texts.mapInArrow(_pack, f"_doc {texts.schema['_doc'].dataType.simpleString()}, _text binary")
    return packed.join(known.hint("merge"), "_doc")


def fit_chain(docs: DataFrame, labels: DataFrame, categories: Sequence[str], doc: str = "doc_id", text: str = "text",
              task_rows: int = TASK_ROWS, folds: int = FOLDS, penalty: float = PENALTY) -> tuple[Chain, DataFrame]:
    """The chain, and its training rows (id, categories, out-of-fold probability of every category).

    ``labels`` has the id and one 0/1 column per category; labels with a null in any of
    them are not used, all others are.  Folds are drawn by hashes of the id, so repeated
    rows share a fold.  A category that never varies gets a probability of next to
    0 or 1, as does every one of an empty table.  The training rows are kept as hashes
    in the shared folder; nothing stays cached.  ``task_rows`` decides how the fits are
    run, not what they are fitted on.
    """
    known = labels.select(F.col(doc).alias("_doc"), *[F.col(c).cast("double").alias(c) for c in categories]).dropna()
    rows = _labelled(docs.select(F.col(doc).alias("_doc"), F.col(text).alias("_text")), known)
    rows = rows.select("_doc", *categories, F.pmod(F.xxhash64(F.lit(7), "_doc"), F.lit(folds)).cast("int").alias("_fold"), "_text")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    with written(rows.mapInArrow(_hash_texts, f"{kinds}, _hashes array<bigint>"), "toxicity-terms") as hashed:
        chain, rows = _fit_chain_across_tasks(hashed, categories, folds, penalty, task_rows // 3) if hashed.count() > task_rows else \
            _fit_chain_in_tasks(cut(hashed), categories, folds, penalty)
    return chain, rows.select(F.col("_doc").alias(doc), *categories, *[f"p_{c}" for c in categories])


def _fit_chain_in_tasks(rows: DataFrame, categories: Sequence[str], folds: int, penalty: float) -> tuple[Chain, DataFrame]:
    """The chain of a table that one task takes, and its training rows: a task per fold and one for all rows."""
    rows = rows.withColumn("_id", F.monotonically_increasing_id())
    models: list[tuple[str, Linear]] = []
    thresholds = {}
    schema = "part int, row long, p double, term long, weight double, kind string"
    for i, category in enumerate(categories):
        before = [f"p_{c}" for c in categories[:i]]
        copies = rows.select(F.explode(F.sequence(F.lit(0), F.lit(folds))).alias("part"), F.col("_id").alias("row"), F.col("_fold").alias("fold"),
                             F.col("_hashes").alias("hashes"), F.col(category).alias("y"), F.array(*before).cast("array<double>").alias("before"))
        fitted = cut(copies.groupBy("part").applyInArrow(_fit_part(i, folds, penalty), schema))
        found = fitted.where("kind <> 'held'").collect()  # the terms with a weight
        weights = {r["term"]: r["weight"] for r in found if r["kind"] == "term"}
        models.append((category, Linear(next((r["weight"] for r in found if r["kind"] == "intercept"), -30.0), weights,
                                        tuple(r["weight"] for r in sorted((r for r in found if r["kind"] == "before"), key=lambda r: r["term"])) or (0.0,) * i)))
        held = fitted.where("kind = 'held'").select(F.col("row").alias("_id"), F.col("p").alias(f"p_{category}"))
        rows = rows.join(held, "_id")
        thresholds[category] = _threshold(rows, category)
    return Chain(tuple(models), thresholds), rows


def predict_chain(docs: DataFrame, chain: Chain, text: str = "text") -> DataFrame:
    """``docs`` with ``p_<category>`` for every category, in chain order; rows one for one.

    Every row is scored on its whole text; a null or empty text has no words and gets the
    models' base rate.  A column of ``docs`` named like a result is replaced; any other
    column, whatever its name, is kept.
    """
    results = [f"p_{c}" for c, _ in chain.models]
    numbered = docs.select(F.struct(*docs.columns).alias("_row"), F.col(text).alias("_text"))
    row_type = numbered.schema["_row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(sorted({t for _, m in chain.models for t in m.terms}), np.int64)
        weights = np.array([[m.terms.get(t, 0.0) for t in names.tolist()] for _, m in chain.models]).reshape(len(chain.models), len(names))
        maybe = np.zeros(1 << 20, bool)  # by a hash's upper bits: whether it can have a weight
        maybe[names >> 12] = True

        def margins(texts: list[str]) -> np.ndarray:
            row, code = _word_terms(texts)
            some = maybe.take(code >> 12)
            found = _distinct(row[some], code[some])
            row, code = found >> 32, found & 0xFFFFFFFF
            at = np.minimum(np.searchsorted(names, code), max(len(names) - 1, 0))
            hit = names[at] == code if len(names) else np.zeros(len(at), bool)
            row, at = row[hit], at[hit]
            return np.stack([np.bincount(row, w[at], len(texts)) for w in weights], axis=1).astype(float)

        for b in batches:
            for part in _chunks([len(t.as_buffer()) if t.is_valid else 0 for t in b.column(1)]):
                z = margins([t or "" for t in b.column(1)[part].to_pylist()])
                p = np.zeros_like(z)
                for k, (_, m) in enumerate(chain.models):
                    p[:, k] = 1 / (1 + np.exp(-(z[:, k] + m.intercept + p[:, :k] @ np.array(m.before))))
                yield pa.RecordBatch.from_arrays([b.column(0)[part], *[pa.array(p[:, k]) for k in range(len(results))]], ["_row", *results])

    out = numbered.mapInArrow(run, f"_row {row_type}, " + ", ".join(f"{r} double" for r in results))
    return out.select(*[F.col("_row")[c].alias(c) for c in docs.columns if c not in results], *results)
