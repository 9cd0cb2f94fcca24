"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes, and how often corpus-wide.

Both tokenizers spell the same bytes, so each token is a byte range.  Per batch of
documents, pandas ``merge_asof`` finds for each token start the other side's covering
token; the union of both directions is all overlapping pairs, and starts that meet exactly
part the groups.  Offsets run on through a batch, which keeps its documents apart: two
tokens of different documents never have an offset in common.

The corpus-wide count of a pair of ids needs a shuffle, but not one of every link.  A task
gathers its documents in blocks of about ``BLOCK_LINKS`` links and numbers a block's
distinct pairs; only these are shuffled, counted and sent back to their block, where the
stored pair numbers of each document are looked up.  So a pair that a third of all links
hold is one row per block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from catalog_lake.llm.common import cut
from catalog_lake.llm.packing import _bytes_of_marks, encoder

#: A block is closed at so many links; a longer document is a block of its own.
BLOCK_LINKS = 3_000_000
#: Texts are aligned together up to so many bytes; a longer one alone.
BATCH_BYTES = 1 << 20

COUNTS = ("n_a", "n_b", "n_groups", "n_links")


class Side:
    """One tokenizer: ids of texts, and the bytes and decimal form of each id."""

    def __init__(self, spelled: list[bytes], last: str, exact: bool = False):
        self.spelled = spelled
        self.exact = exact  # ids spell every text byte for byte
        self.length = np.array([len(s) for s in spelled], np.int64)
        # Eight bytes per id and following mark: inside a group "," and after its last token ``last``.
        if len(spelled) > 9_999_999:
            raise ValueError("ids of more than seven digits")
        self.written = np.array([f"{i}{mark}".encode() for i in range(len(spelled)) for mark in (",", last)], "S8").view(np.uint64)

    def spells(self, ids: np.ndarray, want: bytes) -> bool:
        return self.exact or b"".join(map(self.spelled.__getitem__, ids.tolist())) == want


class ByteLevel(Side):
    """A byte-level BPE file of the tokenizers library; special tokens in a text are ordinary text."""

    def __init__(self, path: str):
        import json
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        marks = _bytes_of_marks()
        special = {t["content"] for t in spec.get("added_tokens", ()) if t["special"]}
        vocab = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        spelled = [b""] * (max(vocab.values()) + 1)
        for t, i in vocab.items():
            spelled[i] = t.encode() if t in special else bytes(marks[c] for c in t)
        # Nothing rewrites the text before the bytes are merged, and every byte has an id.
        before = spec.get("pre_tokenizer") or {}
        exact = spec.get("normalizer") is None and before.get("type") == "ByteLevel" and not before.get("add_prefix_space") \
            and {bytes([i]) for i in range(256)} <= set(spelled)
        super().__init__(spelled, "|", exact)
        self.encoder = encoder(path)

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encoder.ids(" " + text), "<u4").astype(np.int64)


class Pieces(Side):
    """A sentencepiece model, which puts a space before the text itself."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.piece_size())]
        super().__init__([bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
                          for i, p in enumerate(names)], ";")

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text, num_threads=1), np.int64)


@lru_cache(maxsize=2)
def sides(byte_level_path: str, pieces_path: str) -> tuple[ByteLevel, Pieces]:
    return ByteLevel(byte_level_path), Pieces(pieces_path)


def tokens(text: str | None, a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """Both sides' ids; none where the text is null or empty or a side does not spell it."""
    if text:
        want = (" " + text).encode()
        ids = a.ids(text), b.ids(text)
        if a.spells(ids[0], want) and b.spells(ids[1], want):
            return ids
    return np.zeros(0, np.int64), np.zeros(0, np.int64)


def align(batch: list[tuple[np.ndarray, np.ndarray]], a: Side, b: Side) -> tuple[list[np.ndarray], list[str], np.ndarray, np.ndarray]:
    """Counts per document, its groups' digest, and the document and id pair of every link."""
    n_a, n_b = (np.array([len(t[side]) for t in batch], np.int64) for side in (0, 1))
    ids_a, ids_b = (np.concatenate([t[side] for t in batch]) for side in (0, 1))
    if not len(ids_a):
        zero = np.zeros(len(batch), np.int64)
        return [zero] * 4, [""] * len(batch), zero[:0], zero[:0].astype(np.uint64)
    ends_a, ends_b = np.cumsum(a.length[ids_a]), np.cumsum(b.length[ids_b])
    left = pd.DataFrame({"at": ends_a - a.length[ids_a], "i": np.arange(len(ids_a))})
    right = pd.DataFrame({"at": ends_b - b.length[ids_b], "j": np.arange(len(ids_b))})
    covering_b = pd.merge_asof(left, right, on="at")["j"].to_numpy()
    covering_a = pd.merge_asof(right, left, on="at")["i"].to_numpy()
    opens_a = right["at"].to_numpy()[covering_b] == left["at"].to_numpy()  # the token starts a group
    opens_b = left["at"].to_numpy()[covering_a] == right["at"].to_numpy()
    rest = ~opens_b  # pairs that start together are found in both directions
    i = np.concatenate([left["i"].to_numpy(), covering_a[rest]])
    j = np.concatenate([covering_b, right["j"].to_numpy()[rest]])
    doc_a = np.repeat(np.arange(len(batch)), n_a)
    docs = doc_a[i]
    n_groups = np.bincount(doc_a[opens_a], minlength=len(batch))
    n_links = np.bincount(docs, minlength=len(batch))
    digests = _groups(ids_a, ids_b, opens_a, opens_b, n_a, n_b, a, b)
    return [n_a, n_b, n_groups, n_links], digests, docs, ids_a[i].astype(np.uint64) * np.uint64(len(b.spelled)) + ids_b[j].astype(np.uint64)


def _groups(ids_a: np.ndarray, ids_b: np.ndarray, opens_a: np.ndarray, opens_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray,
            a: Side, b: Side) -> list[str]:
    """SHA-256 of every document's groups, written ``a1,a2|b1;a3|b2,b3``; '' without tokens."""
    first_a, first_b = np.flatnonzero(opens_a), np.flatnonzero(opens_b)
    group_a, group_b = np.cumsum(opens_a) - 1, np.cumsum(opens_b) - 1
    closes_a, closes_b = np.append(opens_a[1:], True), np.append(opens_b[1:], True)
    out = np.empty(len(ids_a) + len(ids_b), np.uint64)
    # Before a token of A stand the B tokens of earlier groups, before one of B also its own group's A tokens.
    out[np.arange(len(ids_a)) + first_b[group_a]] = a.written[2 * ids_a + closes_a]
    out[np.arange(len(ids_b)) + np.append(first_a[1:], len(ids_a))[group_b]] = b.written[2 * ids_b + closes_b]
    chars = out.view(np.uint8)
    used = chars != 0
    per_token = used.reshape(-1, 8).sum(axis=1)
    ends = np.append(0, np.cumsum(per_token))[np.append(0, np.cumsum(n_a + n_b))]
    text = memoryview(chars[used])
    return [hashlib.sha256(text[s:e - 1]).hexdigest() if e > s else "" for s, e in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def _pack_block(docs: np.ndarray, pairs: np.ndarray, n_docs: int) -> bytes:
    """A block's links: its sorted distinct pairs with their link counts, and each document's distinct pair numbers with theirs."""
    order = np.sort(docs.astype(np.uint64) << np.uint64(40) | pairs)  # ids of two vocabularies fit 40 bits
    first = np.flatnonzero(np.append(True, order[1:] != order[:-1])) if len(order) else np.zeros(0, np.int64)
    times = np.diff(np.append(first, len(order)))
    own, pair = order[first] >> np.uint64(40), order[first] & np.uint64((1 << 40) - 1)
    distinct = np.unique(pair)
    number = np.searchsorted(distinct, pair)
    steps = np.diff(number, prepend=0)
    starts = np.append(True, own[1:] != own[:-1]) if len(own) else np.zeros(0, bool)
    steps[starts] = number[starts]
    parts = [np.bincount(own.astype(np.int64), minlength=n_docs), steps, times, np.diff(distinct, prepend=np.uint64(0)),
             np.bincount(number, times, minlength=len(distinct)).astype(np.int64)]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(
        [np.array([n_docs, len(own), len(distinct)], "<u4").tobytes(), *[p.astype("<u8" if k == 3 else "<u4").tobytes() for k, p in enumerate(parts)]]))


def _unpack_block(data: bytes) -> list[np.ndarray]:
    """(distinct pairs per document, their numbers, their link counts, the block's pairs, their link counts)."""
    raw = memoryview(zstandard.ZstdDecompressor().decompress(data))
    n_docs, n, n_pairs = (int(x) for x in np.frombuffer(raw[:12], "<u4"))
    at, out = 12, []
    for k, count in enumerate((n_docs, n, n, n_pairs, n_pairs)):
        size = count * (8 if k == 3 else 4)
        out.append(np.frombuffer(raw[at:at + size], "<u8" if k == 3 else "<u4").astype(np.int64))
        at += size
    per_doc, steps, times, pairs, links = out
    number = np.cumsum(steps)
    starts = np.append(0, np.cumsum(per_doc))[:-1][per_doc > 0]
    # steps restart at 0 with each document
    before = np.append(0, number)[starts]
    return [per_doc, number - np.repeat(before, per_doc[per_doc > 0]), times, np.cumsum(pairs), links]


def align_tokens(docs: DataFrame, byte_level_path: str, pieces_path: str, doc: str = "doc_id", text: str = "text",
                 block_links: int = BLOCK_LINKS) -> DataFrame:
    """(doc, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one row per input row.

    A is the byte-level tokenizer over a space and the text, B the sentencepiece model over
    the text.  ``n_links`` counts the pairs of tokens whose byte ranges overlap; a pair of
    ids counts as often as links hold it corpus-wide, ``count_sum`` adds that up over the
    links and ``n_best`` counts those with the highest count of their B id.  A text that is
    null or empty, or that a side does not spell byte for byte, has zeros and ''.  Repeated
    rows and null ids are rows like any other; an empty table gives no rows.
    """
    doc_type = docs.schema[doc].dataType
    arrow_doc = to_arrow_type(doc_type)
    counts = ", ".join(f"{c} bigint" for c in COUNTS)
    names = ["block", "place", "doc", *COUNTS, "groups_sha256", "links"]
    types = [pa.int64(), pa.int64(), arrow_doc, *[pa.int64()] * 4, pa.string(), pa.binary()]

    def tokenised(batches: Iterator[pa.RecordBatch], a: Side, b: Side) -> Iterator[tuple[list, list]]:
        """Ids of documents and their tokens, up to BATCH_BYTES of text at a time."""
        own, found, size = [], [], 0
        for rows in batches:
            texts = rows.column(1)
            for k, d in enumerate(rows.column(0).to_pylist()):
                t = texts[k].as_py()
                own.append(d)
                found.append(tokens(t, a, b))
                size += len(t or "")
                if size >= BATCH_BYTES:
                    yield own, found
                    own, found, size = [], [], 0
        if own:
            yield own, found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = sides(byte_level_path, pieces_path)
        base, block, n_docs, held = TaskContext.get().partitionId() << 32, 0, 0, []

        def closed() -> pa.RecordBatch:
            of, pairs = (np.concatenate(x) for x in zip(*held, strict=True))
            row = [base + block, -1, None, 0, 0, 0, 0, "", _pack_block(of, pairs, n_docs)]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types, strict=True)], names)

        for own, found in tokenised(batches, a, b):
            n, digests, of, pairs = align(found, a, b)
            cols = [np.full(len(own), base + block), np.arange(n_docs, n_docs + len(own)), own, *n, digests, [None] * len(own)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)
            held.append((of + n_docs, pairs))
            n_docs += len(own)
            if sum(len(x[1]) for x in held) >= block_links:
                yield closed()
                block, n_docs, held = block + 1, 0, []
        if held:
            yield closed()

    n_b = len(sides(byte_level_path, pieces_path)[1].spelled)
    rows = cut(docs.select(F.col(doc).alias("doc"), F.col(text).alias("text")).mapInArrow(
        run, f"block bigint, place bigint, doc {doc_type.simpleString()}, {counts}, groups_sha256 string, links binary"))
    blocks = rows.where("place = -1").select("block", "links")
    pairs = blocks.mapInArrow(_block_pairs, "block bigint, number int, pair bigint, n bigint").repartition("pair")
    count = pairs.groupBy("pair").agg(F.sum("n").alias("count"))
    highest = count.groupBy((F.col("pair") % n_b).alias("b")).agg(F.max("count").alias("highest"))
    judged = count.join(highest, F.col("pair") % n_b == F.col("b")).select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))
    known = pairs.join(judged, "pair").select("block", "number", "count", "best")
    out_schema = f"doc {doc_type.simpleString()}, {counts}, n_best bigint, count_sum bigint, groups_sha256 string"

    def look_up(rows: pa.Table, known: pa.Table) -> pa.Table:
        """One block: its documents and its pairs' corpus-wide counts."""
        at = rows.column("place").to_numpy()
        data = rows.column("links")[int(np.flatnonzero(at == -1)[0])].as_py()
        per_doc, number, times, pairs, _ = _unpack_block(data)
        count, best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
        where = known.column("number").to_numpy()
        count[where] = known.column("count").to_numpy()
        best[where] = known.column("best").to_numpy(zero_copy_only=False)
        ends = np.append(0, np.cumsum(per_doc))
        sums = [np.diff(np.append(0, np.cumsum(x[number] * times))[ends]) for x in (best, count)]
        rows = rows.filter(pa.array(at >= 0))
        at = rows.column("place").to_numpy()
        cols = {"doc": rows.column("doc"), **{c: rows.column(c) for c in COUNTS}, "n_best": pa.array(sums[0][at]),
                "count_sum": pa.array(sums[1][at]), "groups_sha256": rows.column("groups_sha256")}
        return pa.table(cols)

    return rows.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(look_up, out_schema)


def _block_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A block's distinct pairs as rows."""
    for rows in batches:
        for block, data in zip(rows.column(0).to_pylist(), rows.column(1), strict=True):
            _, _, _, pairs, links = _unpack_block(data.as_py())
            for at in range(0, len(pairs), 100_000):
                some = slice(at, at + 100_000)
                k = len(pairs[some])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(k, block)), pa.array(np.arange(at, at + k), pa.int32()),
                                                  pa.array(pairs[some]), pa.array(links[some])], ["block", "number", "pair", "n"])
