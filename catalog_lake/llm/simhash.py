"""SimHash near-duplicates by a self-join of binary tries.

Texts become 64-bit fingerprints in one pass (Arrow batches).  Two fingerprints within
``max_bits`` differing bits agree on at least one of ``max_bits + 1`` blocks of bits, so
equal fingerprints are first merged, then dealt out by (block, value).  Each group's
fingerprints are the leaves of one binary trie below that block; the trie is joined with
itself by walking node pairs together, adding up differing bits and dropping a pair as
soon as the sum exceeds the budget.  A trie node is a range of the sorted fingerprints,
so many node pairs advance at once as numpy arrays.  Each task returns a spanning forest
of the links it found, not all pairs; connected components close over them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalog_lake.llm.common import cut, text_key
from catalog_lake.llm.components import components

SEED = 42
#: Members of a (block, value) group that one task joins; larger groups are dealt out in pairs of parts.
GROUP = 4096
#: Node pairs of at most so many leaf pairs are compared leaf by leaf.
LEAF = 512
#: Node pairs that advance together, and leaf pairs that are compared together.
PAIRS, LEAVES = 1 << 16, 1 << 21
#: Shingles whose bits are counted together.
CHUNK = 1 << 15


def _hashes(text: str | None, shingle: int) -> np.ndarray:
    """XXH64 of every word shingle of the lower-cased text."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z change, only the six ASCII blanks part words
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    h = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return np.array([h(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    return np.array([h(joined[s:e], SEED) for s, e in zip(starts[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())],
                    np.uint64)


def fingerprint(text: str | None, shingle: int) -> int:
    """A bit is 1 where over half of the shingles' hashes have it; 0 for a text without words."""
    h = _hashes(text, shingle)
    if not len(h):
        return 0
    counts = np.zeros(64, np.int64)
    for i in range(0, len(h), CHUNK):
        part = h[i:i + CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc: str, text: str, shingle: int) -> DataFrame:
    """(doc, th, fp): id, text hash and fingerprint as a signed long of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t, shingle) for t in b.column("text").to_pylist()]
            kept = [b.column(c) for c in ("doc", "ta", "tb")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(np.array(fps, np.uint64).view(np.int64))], ["doc", "ta", "tb", "fp"])

    th = text_key(text)
    rows = docs.select(F.col(doc).alias("doc"), th["a"].alias("ta"), th["b"].alias("tb"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc {docs.schema[doc].dataType.simpleString()}, ta bigint, tb bigint, fp bigint")


def _roots(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Union of the links (i, j); ``parent`` names each place's root, the smallest place of its set."""
    while len(i):
        a, b = parent[i], parent[j]
        apart = a != b
        if not apart.any():
            break
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent = up
    return parent


def _compare(keys: np.ndarray, parent: np.ndarray, nodes: np.ndarray, budget: int) -> np.ndarray:
    """Leaf by leaf: link the leaves of these node pairs that differ in ``budget`` bits at most."""
    sizes = (nodes[:, 1] - nodes[:, 0]) * (nodes[:, 3] - nodes[:, 2])
    done = np.cumsum(sizes)
    at = 0
    while at < len(nodes):
        to = max(at + 1, int(np.searchsorted(done, (done[at - 1] if at else 0) + LEAVES, "right")))
        n, size = nodes[at:to], sizes[at:to]
        which = np.repeat(np.arange(len(n)), size)
        k = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
        width = (n[:, 3] - n[:, 2])[which]
        i, j = n[which, 0] + k // width, n[which, 2] + k % width
        close = (i < j) & (np.bitwise_count(keys[i] ^ keys[j]) <= budget)
        parent = _roots(parent, i[close], j[close])
        at = to
    return parent


def trie_join(keys: np.ndarray, depth: int, budget: int) -> np.ndarray:
    """Roots of the sets that links of at most ``budget`` differing bits make.

    ``keys`` is sorted and unique; the bits from ``depth`` up name the group, the lower
    ones are the path from the group's trie root to a leaf.  A row of ``nodes`` is a pair
    of trie nodes (two ranges of leaves) with the differing bits so far and the bits left.
    """
    parent = np.arange(len(keys))
    top = keys >> np.uint64(depth)
    first = np.flatnonzero(np.concatenate([[True], top[1:] != top[:-1]]))
    last = np.append(first[1:], len(keys))
    many = last - first > 1
    first, last = first[many], last[many]
    stack = [np.stack([first, last, first, last, np.zeros_like(first), np.full_like(first, depth)], axis=1)]
    while stack:
        nodes = stack.pop()
        if len(nodes) > PAIRS:
            stack += [nodes[PAIRS:]]
            nodes = nodes[:PAIRS]
        leaf = ((nodes[:, 1] - nodes[:, 0]) * (nodes[:, 3] - nodes[:, 2]) <= LEAF) | (nodes[:, 5] == 0)
        parent = _compare(keys, parent, nodes[leaf], budget)
        nodes = nodes[~leaf]
        if not len(nodes):
            continue
        bit = (nodes[:, 5] - 1).astype(np.uint64)
        split = lambda lo: np.searchsorted(keys, ((keys[lo] >> bit) | np.uint64(1)) << bit)  # noqa: E731,B023
        am, bm = split(nodes[:, 0]), split(nodes[:, 2])
        a0, a1, b0, b1, acc, left = nodes.T
        kids = [np.stack(x, axis=1) for x in (
            (a0, am, b0, bm, acc, left - 1), (am, a1, bm, b1, acc, left - 1),
            (a0, am, bm, b1, acc + 1, left - 1), (am, a1, b0, bm, acc + 1, left - 1))]
        kids[3] = kids[3][(a0 != b0)]  # a node with itself: its two mixed pairs are the same
        grown = np.concatenate(kids)
        grown = grown[(grown[:, 0] < grown[:, 1]) & (grown[:, 2] < grown[:, 3]) & (grown[:, 4] <= budget)]
        if len(grown):
            stack.append(grown)
    return parent


def _forest(batches: Iterator[pd.DataFrame], depth: int, budget: int) -> Iterator[pd.DataFrame]:
    """Spanning links of each group; rows come sorted by group, groups may cross batches."""
    def links(rows: pd.DataFrame) -> pd.DataFrame:
        group = np.cumsum(rows["new"].to_numpy()).astype(np.uint64)
        out = []
        at = 0
        per = 1 << (64 - depth)  # groups that fit above the path bits
        while at < len(rows):
            to = int(np.searchsorted(group, group[at] + np.uint64(per - 1)))
            path = rows["path"].to_numpy()[at:to].astype(np.uint64)
            key = ((group[at:to] - group[at]) << np.uint64(depth)) | path
            order = np.argsort(key, kind="stable")
            fp = rows["fp"].to_numpy()[at:to][order]
            root = trie_join(key[order], depth, budget)
            linked = root != np.arange(len(root))
            out.append(pd.DataFrame({"a": fp[linked], "b": fp[root[linked]]}))
            at = to
        return pd.concat(out) if out else pd.DataFrame({"a": [], "b": []}, dtype=np.int64)

    rest: list[pd.DataFrame] = []
    for b in batches:
        if not len(b):
            continue
        rows = pd.concat([*rest, b], ignore_index=True)
        key = rows[["block", "value", "part_a", "part_b"]]
        rows["new"] = (key != key.shift()).any(axis=1).astype(np.uint64)
        begins = np.flatnonzero(rows["new"].to_numpy())
        cut_at = int(begins[-1])  # the last group may go on in the next batch
        if cut_at:
            yield links(rows.iloc[:cut_at])
        rest = [rows.iloc[cut_at:].drop(columns="new")]
    if rest:
        rows = rest[0].reset_index(drop=True)
        rows["new"] = np.concatenate([[1], np.zeros(len(rows) - 1)]).astype(np.uint64)
        yield links(rows)


def close_pairs(fps: DataFrame, max_bits: int = 3, group: int = GROUP) -> DataFrame:
    """(a, b): a spanning forest of the links between distinct fingerprints ``fp``.

    Blocks of 64 / (max_bits + 1) bits: close fingerprints agree on one block at least.
    A group of more than ``group`` members is dealt out in parts, and every pair of parts
    is a group of its own, so no task joins more than about twice ``group`` rows.
    """
    blocks = max_bits + 1
    width = -(-64 // blocks)
    depth = 64 - width
    block = []
    for i in range(blocks):
        shift = min(i * width, depth)  # the last block may overlap the one before; that only finds a link twice
        value = F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1))
        low = F.col("fp").bitwiseAND(F.lit((1 << shift) - 1)) if shift else F.lit(0).cast("long")
        high = F.shiftrightunsigned("fp", shift + width) if shift + width < 64 else F.lit(0).cast("long")
        block.append(F.struct(F.lit(i).alias("block"), value.alias("value"),
                              F.shiftleft(high, shift).bitwiseOR(low).alias("path")))
    dealt = fps.select("fp", F.explode(F.array(*block)).alias("x")).select("fp", "x.*")
    hot = dealt.groupBy("block", "value").count().where(F.col("count") > group) \
        .select("block", "value", F.ceil(F.col("count") / group).cast("int").alias("parts"))
    dealt = dealt.join(hot, ["block", "value"], "left")
    part = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    pairs = F.when(F.col("parts").isNull(), F.array(F.struct(F.lit(0).alias("part_a"), F.lit(0).alias("part_b")))).otherwise(
        F.transform(F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: j != part),
                    lambda j: F.struct(F.least(j, part).alias("part_a"), F.greatest(j, part).alias("part_b"))))
    keys = ["block", "value", "part_a", "part_b"]
    rows = dealt.select("block", "value", F.inline(pairs), "path", "fp")
    rows = rows.repartition(*keys).sortWithinPartitions(*keys)
    return rows.mapInPandas(lambda it: _forest(it, depth, max_bits), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, doc: str = "doc_id", text: str = "text", shingle: int = 3,
                    max_bits: int = 3) -> DataFrame:
    """(doc, ta, tb, fp, component, first): one row per input row.

    ``component`` is the smallest id reachable over links of at most ``max_bits`` differing
    bits, ``first`` the (id, text hash) of the group's row to keep.  A text without words,
    null texts too, has fingerprint zero and links like any other.  A row without an id
    belongs to its group but never names it while another row has an id; a group without
    any id has a null component.  Repeated rows come out as often as they come in.  The
    fingerprints are cut to the shared folder, so a lost executor costs no second pass
    over the texts.
    """
    prints = cut(fingerprints(docs, doc, text, shingle))
    name = F.struct(F.col("doc").isNull().alias("no_id"), "doc", "ta", "tb")
    by_fp = cut(prints.groupBy("fp").agg(F.min(name).alias("least")))
    roots = components(close_pairs(by_fp.select("fp"), max_bits))
    of_fp = by_fp.join(roots.withColumnRenamed("node", "fp"), "fp", "left") \
        .select("fp", F.coalesce("root", "fp").alias("root"), "least")
    of_root = of_fp.groupBy("root").agg(F.min("least").alias("first"))
    named = of_fp.select("fp", "root").join(of_root, "root").select("fp", "first")
    return prints.join(named, "fp").select("doc", "ta", "tb", "fp", F.col("first.doc").alias("component"), "first")


def keep_one(docs: DataFrame, doc: str = "doc_id", text: str = "text", shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """The documents' rows, one of each group: the one with the smallest id, ties by text hash and row."""
    groups = near_duplicates(docs, doc, text, shingle, max_bits)
    firsts = groups.select("first.doc", "first.ta", "first.tb").distinct()
    rows = docs.select(F.struct("*").alias("row"))
    th = text_key(F.col("row")[text])
    rows = rows.select("row", F.col("row")[doc].alias("id"), th["a"].alias("xa"), th["b"].alias("xb"))
    kept = rows.join(firsts, F.col("id").eqNullSafe(F.col("doc")) & F.col("xa").eqNullSafe(F.col("ta"))
                     & F.col("xb").eqNullSafe(F.col("tb")), "left_semi")
    # Exact repeats of a row share id and text: one of them stays.
    order = Window.partitionBy("id", "xa", "xb").orderBy(F.xxhash64("row"))
    return kept.withColumn("n", F.row_number().over(order)).where("n = 1").select("row.*")
