"""Sum-of-squares online packing of tokenised documents into fixed windows.

Each task tokenises its documents and packs them as they come.  Whole windows of a long
document stand alone; its remainder goes to the fill level that makes the sum of the
squared counts of partially filled windows smallest (Csirik et al. 2006), found in an
array that holds the count of every level.  What is still open when the task ends is cut
to fill its windows, and the last remainder is cut at powers of two, which need no
padding.  Nothing is shuffled; a task's windows depend on its input split alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

WINDOW = 1024
END_ID = 0
#: Below this character the two tokenizer libraries' Unicode tables cannot differ.
COMMON = "\u0250"


def _bytes_of_marks() -> dict[str, int]:
    """The printable marks that byte-level vocabularies write bytes as: themselves, or from U+0100 in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Ids of whole texts as the tokenizers library gives them.

    A byte-level BPE with GPT-2's pattern is also read by tiktoken, several times as fast
    and with the same ids; it takes the texts in ASCII and the Latin blocks.  All other
    texts, and all texts of another kind of tokenizer, go to the tokenizers library.

    With ``as_loaded`` the string of a special token in a text gets that token's id, as the
    library does it unasked; without, it is ordinary text.  Texts that hold the string of a
    token with an id of its own go to the tokenizers library.
    """

    PROBE = "It's 1,000 días;\n\n  où  «naïve» façade\t— übermäßig groß... it'll do!\r\n \u00a0x<|endoftext|> "

    def __init__(self, path: str, as_loaded: bool = False):
        import json

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not as_loaded
        self.fast = None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"] for t in spec.get("added_tokens", ())}
        self.whole = [t["content"] for t in spec.get("added_tokens", ()) if as_loaded or not t["special"]]
        marks = _bytes_of_marks()
        if spec["model"]["type"] == "BPE" and (spec.get("pre_tokenizer") or {}).get("type") == "ByteLevel" and not spec.get("normalizer"):
            ranks = {bytes(marks[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
            fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            probe = self.PROBE
            for t in self.whole:
                probe = probe.replace(t, "")
            if fast.encode_ordinary(probe) == self._slow(probe).tolist():
                self.fast = fast

    def _slow(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of the text."""
        if self.fast and (text.isascii() or max(text) < COMMON) and not any(t in text for t in self.whole):
            return np.asarray(self.fast.encode_to_numpy(text, disallowed_special=()), "<u4").tobytes()
        return self._slow(text).tobytes()


@lru_cache(maxsize=2)
def encoder(path: str, as_loaded: bool = False) -> Encoder:
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path, as_loaded)


class SumOfSquares:
    """The open windows by fill level; ``count[h]`` is the level array."""

    def __init__(self, window: int):
        self.window = window
        self.count = np.zeros(window + 1, np.int64)
        self.open: dict[int, list[list]] = {}

    def level(self, size: int) -> int:
        """The fill level to place ``size`` on; 0 starts a window.  Ties go to the fullest."""
        n, w = self.count, self.window
        before, after = n[:w - size + 1], n[size:w + 1]
        change = 2 * (after - before + 1)  # the window leaves level h and joins level h + size
        change[0] = 2 * after[0] + 1       # a new window leaves no level
        change[-1] = 1 - 2 * before[-1] if size < w else 0  # a full window counts at no level
        cost = np.where(before > 0, change, np.iinfo(np.int64).max)
        cost[0] = change[0]
        return len(cost) - 1 - int(np.argmin(cost[::-1]))

    def place(self, size: int, piece) -> list | None:
        """Put the piece down; the pieces of its window if that is now full."""
        h = self.level(size)
        pieces = self.open[h].pop() if h else []
        pieces.append(piece)
        if h:
            self.count[h] -= 1
        if h + size == self.window:
            return pieces
        self.count[h + size] += 1
        self.open.setdefault(h + size, []).append(pieces)
        return None

    def rest(self) -> list:
        """Every piece of the open windows, the fullest windows first."""
        return [p for h in sorted(self.open, reverse=True) for pieces in self.open[h] for p in pieces]


def sequences(docs: Iterator[tuple[object, bytes]], window: int) -> Iterator[list[tuple]]:
    """Sequences as lists of pieces (document, first id's place, ids, the document's ids in all)."""
    levels = SumOfSquares(window)
    for doc, ids in docs:
        total = len(ids) // 4
        whole = total - total % window
        for at in range(0, whole, window):
            yield [(doc, at, ids[4 * at:4 * (at + window)], total)]
        if total > whole and (full := levels.place(total - whole, (doc, whole, ids[4 * whole:], total))):
            yield full
    # Open windows: cut freely into full windows, then into powers of two.
    pieces, at = levels.rest(), 0
    left = sum(len(p[2]) for p in pieces) // 4
    while left:
        room = window if left >= window else 1 << (left.bit_length() - 1)
        out, left = [], left - room
        while room:
            doc, start, ids, total = pieces[at]
            take = min(room, len(ids) // 4)
            out.append((doc, start, ids[:4 * take], total))
            pieces[at] = (doc, start + take, ids[4 * take:], total)
            at += take == len(ids) // 4
            room -= take
        yield out


def pack(docs: DataFrame, tokenizer_path: str, doc: str = "doc_id", text: str = "text", window: int = WINDOW,
         end_id: int = END_ID, with_ids: bool = False, as_loaded: bool = False) -> DataFrame:
    """One row per piece: doc, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked, ids.

    Every document, repeated ones too, is its ids and then ``end_id``; a null or empty text
    is that id alone.  Each id lies in exactly one piece.  Sequences have ``window`` ids,
    but for the at most log2(window) last ones of a task, which are powers of two.
    Sequence ids are the task's number and a count, so a task that runs again gives the
    same rows.  ``doc`` may be null or repeat.  An empty table gives no rows.  ``as_loaded``
    is the encoder's.
    """
    doc_type = docs.schema[doc].dataType
    arrow_type = to_arrow_type(doc_type)
    fields = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    names = ["doc", *[f.split()[0] for f in fields.split(", ")], *["ids"] * with_ids]
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, base = encoder(tokenizer_path, as_loaded), TaskContext.get().partitionId() << 40

        def tokenised() -> Iterator[tuple[object, bytes]]:
            for b in batches:
                texts = b.column(1)
                for i, d in enumerate(b.column(0).to_pylist()):
                    yield d, enc.ids(texts[i].as_py() or "") + end

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True))
            types = [arrow_type, *[pa.int64()] * 6, *[pa.binary()] * with_ids]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)

        rows: list[tuple] = []
        for k, pieces in enumerate(sequences(tokenised(), window)):
            at = 0
            for d, start, ids, total in pieces:
                n = len(ids) // 4
                rows.append((d, start, n, zlib.crc32(ids), total, base + k, at, *[ids] * with_ids))
                at += n
            if len(rows) >= 5000:
                yield batch(rows)
                rows = []
        if rows:
            yield batch(rows)

    out = docs.select(F.col(doc).alias("doc"), F.col(text).alias("text"))
    return out.mapInArrow(run, f"doc {doc_type.simpleString()}, {fields}" + ", ids binary" * with_ids)
