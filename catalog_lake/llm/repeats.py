"""Distinct texts by document, and which hashes more than one document has."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalog_lake.llm.common import text_key

_U = np.uint64


def identify(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """(doc, v, ta, tb, n): the distinct texts by their smallest id; ``v`` tells texts with one id apart."""
    th = text_key(text)
    reps = docs.where(F.col(doc).isNotNull()).select(F.col(doc).alias("doc"), th["a"].alias("ta"), th["b"].alias("tb")) \
        .groupBy("ta", "tb").agg(F.min("doc").alias("doc"), F.count("*").alias("n"))
    return reps.withColumn("v", F.row_number().over(Window.partitionBy("doc").orderBy("ta", "tb")) - 1)


def distinct_texts(docs: DataFrame, reps: DataFrame, doc: str, text: str) -> DataFrame:
    """(doc, v, z): each distinct text once, compressed, partitioned by document."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=3)
        for b in batches:
            packed = pa.array([z.compress((t.as_py() or "").encode()) for t in b.column("text")], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("doc"), b.column("ta"), b.column("tb"), packed], ["doc", "ta", "tb", "z"])

    th = text_key(text)
    rows = docs.where(F.col(doc).isNotNull()).select(
        F.col(doc).cast("long").alias("doc"), th["a"].alias("ta"), th["b"].alias("tb"), F.col(text).alias("text"))
    rows = rows.mapInArrow(pack, "doc bigint, ta bigint, tb bigint, z binary")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Partitioned by ``doc`` alone and into the shuffle's own number, so that joins on ``doc`` find the rows in place.
    # Ranges, as equalities would become join keys and part the texts by them too.
    spread = rows.repartition(n, "doc").join(reps.withColumnRenamed("ta", "ra").withColumnRenamed("tb", "rb"), "doc")
    same = spread.where(F.col("ta").between(F.col("ra"), F.col("ra")) & F.col("tb").between(F.col("rb"), F.col("rb")))
    return same.select("doc", "v", "z").dropDuplicates(["doc", "v"])


def persist_in_place(df: DataFrame) -> DataFrame:
    """Persist with the partitioning kept, so that later joins need not shuffle the texts again."""
    conf = df.sparkSession.conf
    before = {k: conf.get(k) for k in ("spark.sql.optimizer.canChangeCachedPlanOutputPartitioning", "spark.sql.adaptive.enabled")}
    for k in before:
        conf.set(k, "false")
    try:
        return df.persist()
    finally:
        for k, v in before.items():
            conf.set(k, v)


def unpack(z: pa.Array) -> Iterator[bytes]:
    un = zstandard.ZstdDecompressor()
    return (un.decompress(x.as_py()) for x in z)


def repeated(texts: DataFrame, hashes: Callable[[bytes], np.ndarray]) -> DataFrame:
    """(doc, codes, bits): the hashes of every document's text that another document has too."""
    def of(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        hs = [np.unique(hashes(t)) for t in unpack(b.column("z"))]
        return np.repeat(np.arange(len(hs)), [len(h) for h in hs]), np.concatenate(hs)

    return repeated_in(texts, of)


def repeated_in(rows: DataFrame, hashes: Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """(doc, codes, bits): the hashes of every document's row that another document has too.

    ``hashes`` gives (place of the row, hash) of a batch with ``doc``.  A hash is cut to 32 bits within one of 2^b buckets; a chance match costs some work
    later and no error.  Per Arrow batch and bucket one row holds the hashes and, delta
    coded, the documents.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = max(1, (4 * n - 1).bit_length())

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=1)
        for b in batches:
            if not b.num_rows:
                continue
            at, h = hashes(b)
            d = b.column("doc").to_numpy(zero_copy_only=False)[at]
            bucket = (h >> _U(64 - bits)).astype(np.int64)
            order = np.lexsort((d, bucket))
            h, d, bucket = h[order], d[order], bucket[order]
            cuts = np.searchsorted(bucket, np.arange((1 << bits) + 1))
            packed = [(k, h[i:j].astype(np.uint32).tobytes(), z.compress(np.diff(d[i:j], prepend=0).tobytes()))
                    for k, (i, j) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)) if i < j]
            if packed:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*packed, strict=True), (pa.int64(), pa.binary(), pa.binary()), strict=True)],
                    ["bucket", "h", "d"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        un = zstandard.ZstdDecompressor()
        of: dict[int, list[tuple[bytes, bytes]]] = defaultdict(list)
        for b in batches:
            for k, h, d in zip(*(c.to_pylist() for c in b.columns), strict=True):
                of[k].append((h, d))
        for k in sorted(of):
            parts = of.pop(k)
            h = np.concatenate([np.frombuffer(x, np.uint32) for x, _ in parts])
            d = np.concatenate([np.cumsum(np.frombuffer(un.decompress(x), np.int64)) for _, x in parts])
            order = np.argsort(h, kind="stable")
            h, d = h[order], d[order]
            first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            many = np.minimum.reduceat(d, first) < np.maximum.reduceat(d, first)
            many = np.repeat(many, np.diff(np.append(first, len(h))))
            yield pa.RecordBatch.from_arrays([pa.array(d[many]), pa.array((k << 32) | h[many].astype(np.int64))], ["doc", "code"])

    met = rows.mapInArrow(emit, "bucket bigint, h binary, d binary").repartition(n, "bucket") \
        .mapInArrow(meet, "doc bigint, code bigint")
    return met.groupBy("doc").agg(F.collect_list("code").alias("codes"), F.lit(bits).alias("bits"))


def code_of(h: np.ndarray, bits: int) -> np.ndarray:
    """The code that ``repeated`` gives a hash: its bucket, and 32 bits of it."""
    return ((h >> _U(64 - bits)).astype(np.int64) << 32) | (h & _U(0xFFFFFFFF)).astype(np.int64)
