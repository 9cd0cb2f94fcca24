"""K1/K4/A8 on a keyed table whose files cover key ranges: a batch rewrites the files it touches.

A table is Parquet files in *slots*, ranges of the key that do not overlap, and a manifest
per version that lists every slot's files with its smallest and largest key.  A merge looks
up the slots of the batch's keys, reads and rewrites those alone, and writes a manifest that
names the new files beside all the others, which stay where they are.  A version is its
manifest, put in place by one rename: readers see the old table or the new one.

The manifest (two keys and the names of files of about ``rows_per_file`` rows) is held by
the driver and sent to tasks, as table formats do: tens of bytes per file, a few MB for 100,000.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog_lake.operators.dedup import keep_one
from catalog_lake.sources.rounds import _fs

ROWS_PER_FILE = 2_000_000
FEW_TASKS = 200


@dataclass(frozen=True)
class Slot:
    """A range of keys and the files that hold its rows."""

    low: int | str
    high: int | str
    files: tuple[str, ...]
    rows: int


class KeyedTable:
    """A table keyed by ``key`` (a whole number or text), stored in ``folder``; null keys are not stored."""

    def __init__(self, spark: SparkSession, folder: str, key: str, ddl: str, rows_per_file: int = ROWS_PER_FILE):
        self.spark, self.folder, self.key, self.ddl, self.rows_per_file = spark, folder.rstrip("/"), key, ddl, rows_per_file

    # -- versions ----------------------------------------------------------------------
    def versions(self) -> list[int]:
        fs, path, _ = _fs(self.spark, f"{self.folder}/manifests")
        return sorted(int(s.getPath().getName()[1:]) for s in fs.listStatus(path) if s.getPath().getName().startswith("v")) if fs.exists(path) else []

    def slots(self, version: int | None = None) -> list[Slot]:
        """The slots of a version (the newest), by key."""
        have = self.versions()
        if not have:
            return []
        fs, path, jvm = _fs(self.spark, f"{self.folder}/manifests/v{have[-1] if version is None else version}")
        stream = fs.open(path)
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        return [Slot(x["low"], x["high"], tuple(x["files"]), x["rows"]) for x in json.loads(text)]

    def _publish(self, slots: list[Slot]) -> None:
        version = max(self.versions(), default=0) + 1
        fs, tmp, jvm = _fs(self.spark, f"{self.folder}/manifests/_{uuid.uuid4().hex}")
        out = fs.create(tmp, True)
        out.write(bytearray(json.dumps([asdict(s) for s in sorted(slots, key=lambda s: s.low)]).encode()))
        out.close()
        if not fs.rename(tmp, jvm.org.apache.hadoop.fs.Path(f"{self.folder}/manifests/v{version}")):
            raise RuntimeError(f"version {version} was published by another writer")

    # -- reading -----------------------------------------------------------------------
    def _read(self, slots: Sequence[Slot]) -> DataFrame:
        files = [f for s in slots for f in s.files]
        return self.spark.read.schema(self.ddl).parquet(*files) if files else self.spark.createDataFrame([], self.ddl)

    def read(self, version: int | None = None) -> DataFrame:
        return self._read(self.slots(version))

    def find(self, keys: Sequence[int | str]) -> DataFrame:
        """The rows of a few keys: only the files whose range holds one are opened."""
        slots = [s for s in self.slots() if any(s.low <= k <= s.high for k in keys)]
        return self._read(slots).filter(F.col(self.key).isin(list(keys)))

    # -- writing -----------------------------------------------------------------------
    def overwrite(self, rows: DataFrame) -> None:
        """The whole table anew, range-partitioned and sorted by the key."""
        rows = rows.filter(F.col(self.key).isNotNull()).select(*T.StructType.fromDDL(self.ddl).fieldNames())
        n = max(1, -(-rows.count() // self.rows_per_file))
        path = f"{self.folder}/data/{uuid.uuid4().hex}"
        # A task writes many files, one after the other in the order of the key: tasks follow the rows, not the files,
        # as what a task reports to the driver is far larger than a file's line in the manifest.
        tasks = self._tasks(n, n * self.rows_per_file)
        rows.repartitionByRange(tasks, self.key).sortWithinPartitions(self.key) \
            .write.option("maxRecordsPerFile", self.rows_per_file if tasks < n else 0).parquet(path)
        self._publish(self._slots_of(path))

    def _tasks(self, files: int, rows: int) -> int:
        """How many tasks write so many files: one each up to FEW_TASKS or the usual number, then as many as the rows ask for."""
        usual = max(FEW_TASKS, int(self.spark.conf.get("spark.sql.shuffle.partitions", "200")))
        return max(1, min(files, max(usual, -(-rows // ROWS_PER_FILE))))

    def _slots_of(self, path: str) -> list[Slot]:
        """The slots of newly written files; files that share a key are one slot."""
        rows = self.spark.read.schema(self.ddl).parquet(path).groupBy(F.col("_metadata.file_path").alias("file")) \
            .agg(F.min(self.key).alias("low"), F.max(self.key).alias("high"), F.count(F.lit(1)).alias("n")).orderBy("low", "high", "file").collect()
        out: list[Slot] = []
        for r in rows:
            if out and r["low"] <= out[-1].high:
                out[-1] = Slot(out[-1].low, max(out[-1].high, r["high"]), (*out[-1].files, r["file"]), out[-1].rows + r["n"])
            else:
                out.append(Slot(r["low"], r["high"], (r["file"],), r["n"]))
        return out

    def _with_slot(self, rows: DataFrame, slots: list[Slot]) -> DataFrame:
        """Adds ``_slot``, the number of the slot that holds the key or is to take it: the last that starts at or before it."""
        lows = [s.low for s in slots]
        text = bool(lows) and isinstance(lows[0], str)
        starts = np.array(lows, dtype=object if text else np.int64)
        at, schema = rows.columns.index(self.key), rows.schema

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                keys = np.array(b.column(at).to_pylist(), dtype=starts.dtype)
                place = np.maximum(np.searchsorted(starts, keys, side="right") - 1, 0)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(place.astype(np.int32))], [*b.schema.names, "_slot"])

        return rows.mapInArrow(run, T.StructType([*schema.fields, T.StructField("_slot", T.IntegerType())]))

    def merge(self, batch: DataFrame, gone: DataFrame | None = None) -> int:
        """K4: drop the rows whose key is in ``gone`` (the batch's keys), add the batch; the number of slots rewritten.

        ``gone`` names keys in a column of the key's name, so a parent that comes without
        rows loses its old ones.  The touched slots are rewritten each to files of its own.
        """
        names = T.StructType.fromDDL(self.ddl).fieldNames()
        batch = batch.filter(F.col(self.key).isNotNull()).select(*names)
        gone = (batch if gone is None else gone).select(self.key).filter(F.col(self.key).isNotNull()).distinct()
        slots = self.slots()
        if not slots:
            self.overwrite(batch)
            return len(self.slots())
        keys = self._with_slot(gone.unionByName(batch.select(self.key)).distinct(), slots)
        touched = [r[0] for r in keys.select("_slot").distinct().collect()]  # at most one number per slot
        if not touched:
            return 0
        old = self._read([slots[i] for i in touched]).join(gone, self.key, "left_anti").select(*names)
        rows = self._with_slot(old.unionByName(batch), slots)
        path = f"{self.folder}/data/{uuid.uuid4().hex}"
        # Ranges of (slot, key): a slot with many rows takes several tasks; a file that doubles is split.
        held = sum(slots[i].rows for i in touched)
        n = max(len(touched), -(-held // (2 * self.rows_per_file)))
        rows.repartitionByRange(self._tasks(n, held), "_slot", self.key).sortWithinPartitions("_slot", self.key) \
            .write.option("maxRecordsPerFile", 2 * self.rows_per_file).partitionBy("_slot").parquet(path)
        self._publish([s for i, s in enumerate(slots) if i not in set(touched)] + self._slots_of(path))
        return len(touched)

    def upsert(self, batch: DataFrame, order: Sequence[Column | str] | None = None) -> int:
        """K1: the batch's rows replace or join the table's, one per key (the first by ``order``, default all columns)."""
        order = list(order) if order is not None else [c for c in T.StructType.fromDDL(self.ddl).fieldNames() if c != self.key]
        return self.merge(keep_one(batch.filter(F.col(self.key).isNotNull()), self.key, order))
