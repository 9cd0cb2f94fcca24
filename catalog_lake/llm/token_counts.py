"""Word-piece token counts by a linear longest-match automaton.

The vocabulary is a byte trie.  Every node has a failure link, the node where matching
goes on when its longest pieces so far are taken off, and the number of pieces that takes
off (Song et al. 2021).  A word is read once, byte by byte; summing the popped counts
gives the number of greedy longest-match pieces, and no piece is ever built.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Distinct words whose length a Python worker remembers.
WORDS = 200_000


class Automaton:
    """Trie with failure links over the pieces of a vocabulary."""

    def __init__(self, pieces: Iterable[bytes]):
        self.next: dict[int, int] = {}  # node << 8 | byte -> node; the root is 0
        final, parents = [False], [(0, 0)]
        for piece in pieces:
            node = 0
            for c in piece:
                key = node << 8 | c
                if (child := self.next.get(key)) is None:
                    child = self.next[key] = len(final)
                    final.append(False)
                    parents.append((node, c))
                node = child
            final[node] = node > 0
        depth = [0] * len(final)
        for v in range(1, len(final)):
            depth[v] = depth[parents[v][0]] + 1
        self.fail, self.popped = [-1] * len(final), [0] * len(final)  # -1: no way on
        for v in sorted(range(1, len(final)), key=depth.__getitem__):
            if final[v]:
                self.fail[v], self.popped[v] = 0, 1
                continue
            parent, c = parents[v]
            z, n = self.fail[parent], self.popped[parent]
            while z >= 0 and (z << 8 | c) not in self.next:
                z, n = self.fail[z], n + self.popped[z]
            if z >= 0:
                self.fail[v], self.popped[v] = self.next[z << 8 | c], n

    def count(self, word: bytes) -> int:
        """Pieces of the greedy longest match; -1 if some byte starts no piece there."""
        step, fail, popped = self.next, self.fail, self.popped
        node = n = 0
        for c in word:
            while (to := step.get(node << 8 | c)) is None:
                n += popped[node]
                node = fail[node]
                if node < 0:
                    return -1
            node = to
        while node:
            n += popped[node]
            node = fail[node]
            if node < 0:
                return -1
        return n


class Lengths(dict):
    """Word -> pieces, remembered up to a bound."""

    def __init__(self, automaton: Automaton, mark: bytes):
        super().__init__()
        self.automaton, self.mark = automaton, mark

    def __missing__(self, word: bytes) -> int:
        n = self.automaton.count(self.mark + word)
        if len(self) >= WORDS:
            self.clear()
        self[word] = n
        return n


def read_vocabulary(path: str) -> list[bytes]:
    """Pieces of a vocabulary file: one base64 piece and its rank a line."""
    with open(path, "rb") as f:
        return [base64.b64decode(line.split()[0]) for line in f if line.strip()]


@lru_cache(maxsize=2)
def lengths(path: str, mark: bytes) -> Lengths:
    return Lengths(Automaton(read_vocabulary(path)), mark)


def token_counts(docs: DataFrame, vocabulary_path: str, doc: str = "doc_id", text: str = "text",
                 mark: bytes = b" ") -> DataFrame:
    """(doc, n_words, n_tokens, n_unknown, max_word_tokens), one row per input row, no shuffle.

    Words are parted by the six ASCII blanks; each is matched with ``mark`` (the
    vocabulary's word start) before it.  A word that the vocabulary cannot spell is one
    token and counted in ``n_unknown``.  A null, empty or blank text has zeros.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = lengths(vocabulary_path, mark)
        for b in batches:
            out = []
            for t in b.column(1):
                words = (t.as_py() or "").encode().split()
                n = np.array([known[w] for w in words], np.int64)
                bad = int((n < 0).sum())
                out.append((len(words), int(n[n > 0].sum()) + bad, bad, int(np.abs(n).max(initial=0))))
            cols = zip(*out, strict=True) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, pa.int64()) for c in cols]],
                                             ["doc", "n_words", "n_tokens", "n_unknown", "max_word_tokens"])

    kind = docs.schema[doc].dataType.simpleString()
    return docs.select(F.col(doc).alias("doc"), F.col(text).alias("text")).mapInArrow(
        run, f"doc {kind}, n_words bigint, n_tokens bigint, n_unknown bigint, max_word_tokens bigint")
