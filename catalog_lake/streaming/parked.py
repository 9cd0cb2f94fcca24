"""Micro-batch upsert with parked orphans (J7 -> K1 -> K4, retried with every batch).

A record whose parent has not arrived yet is parked and tried again with each later
batch.  The store is a log of epochs: a batch writes only its own rows, so its cost
follows the batch (and the parked rows), not the table.

    <folder>/parents/epoch=<n>/            parents of the batch, one per key
    <folder>/records/epoch=<n>/loaded=…/   loaded records; loaded=false holds all that is parked after epoch n
    <folder>/base/epoch=<n>/{parents,records}/   all epochs up to n folded into one (``compact``)
    <folder>/ledger/{epoch,base}-<n>       the commits; what has no entry is not read

An epoch is committed by its ledger entry, written last and in one step.  A batch that runs
again after its commit is a no-op; one that died before it overwrites its own folder.  The
current row of a key is the one of the latest epoch, and a record brings its children as a
nested list, so replacing them (K4) is reading the latest list.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog_lake.operators.dedup import keep_one
from catalog_lake.operators.upsert import latest_per_key
from catalog_lake.sources.rounds import _fs


@dataclass(frozen=True)
class Entity:
    """A keyed table: its key column and its columns as DDL."""

    key: str
    ddl: str

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


class ParkedUpsert:
    """Keyed upsert of ``records`` that belong to ``parents`` by ``parent_ref``, both arriving in any order.

    Batches have a column ``kind`` ('parent' or 'record') and the columns of both entities.
    Rows with a null key are dropped (F13).  Among a batch's rows of one key the first by
    ``order`` survives (default: all other columns); a row of a later batch replaces it,
    and a parked record gives way to a newer one of its key.
    """

    def __init__(self, spark: SparkSession, folder: str, parents: Entity, records: Entity, parent_ref: str,
                 order: Sequence[Column | str] | None = None):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.parent_entity, self.record_entity, self.parent_ref, self.order = parents, records, parent_ref, order

    # -- ledger ------------------------------------------------------------------------
    def _entries(self, kind: str) -> list[int]:
        fs, path, _ = _fs(self.spark, f"{self.folder}/ledger")
        if not fs.exists(path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        return sorted(int(n.split("-")[1]) for n in names if n.startswith(f"{kind}-"))

    def _commit(self, kind: str, epoch: int) -> None:
        fs, path, _ = _fs(self.spark, f"{self.folder}/ledger/{kind}-{epoch}")
        fs.create(path, True).close()

    def committed(self) -> list[int]:
        """The epochs that count."""
        return self._entries("epoch")

    # -- reading -----------------------------------------------------------------------
    def _log(self, name: str, entity: Entity) -> DataFrame:
        """The committed rows of a table with their epoch: the newest base and the epochs after it."""
        base = max(self._entries("base"), default=None)
        schema = T.StructType([*entity.schema.fields, T.StructField("_epoch", T.LongType())])
        paths = [f"{self.folder}/base/epoch={base}/{name}"] if base is not None else []
        paths += [f"{self.folder}/{name}/epoch={e}" + ("/loaded=true" if name == "records" else "")
                  for e in self.committed() if base is None or e > base]
        paths = [p for p in paths if self._exists(p)]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def _exists(self, path: str) -> bool:
        fs, p, _ = _fs(self.spark, path)
        return fs.exists(p)

    def _latest(self, name: str, entity: Entity) -> DataFrame:
        return latest_per_key(self._log(name, entity), entity.key, "_epoch")

    def parents(self) -> DataFrame:
        """The current parents."""
        return self._latest("parents", self.parent_entity).select(*self.parent_entity.columns)

    def records(self) -> DataFrame:
        """The current records whose parent has arrived."""
        return self._latest("records", self.record_entity).select(*self.record_entity.columns)

    def children(self, nested: str, alias: str = "child") -> DataFrame:
        """K4: the children of the current records, one row each."""
        r = self.records()
        return r.select(*[c for c in r.columns if c != nested], F.explode(nested).alias(alias))

    def parked(self) -> DataFrame:
        """The records that still wait for their parent, with the epoch they came in."""
        schema = T.StructType([*self.record_entity.schema.fields, T.StructField("_epoch", T.LongType())])
        last = max(self.committed(), default=None)
        path = f"{self.folder}/records/epoch={last}/loaded=false"
        if last is None or not self._exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    # -- writing -----------------------------------------------------------------------
    def _one_per_key(self, rows: DataFrame, entity: Entity) -> DataFrame:
        order = list(self.order) if self.order is not None else [c for c in entity.columns if c != entity.key]
        return keep_one(rows.filter(F.col(entity.key).isNotNull()), entity.key, [F.col("_epoch").desc(), *order])

    def handle(self, batch: DataFrame, epoch: int) -> None:
        """The ``foreachBatch`` handler."""
        if epoch in self.committed():
            return  # this batch ran to its end before
        stamped = batch.withColumn("_epoch", F.lit(epoch).cast("bigint"))
        came = stamped.filter("kind = 'parent'").select(*self.parent_entity.columns, "_epoch")
        self._write(self._one_per_key(came, self.parent_entity), f"parents/epoch={epoch}")
        schema = T.StructType([*self.parent_entity.schema.fields, T.StructField("_epoch", T.LongType())])
        here = self.spark.read.schema(schema).parquet(f"{self.folder}/parents/epoch={epoch}")
        known = self._log("parents", self.parent_entity).unionByName(here).select(F.col(self.parent_entity.key).alias(self.parent_ref)).distinct()
        rows = stamped.filter("kind = 'record'").select(*self.record_entity.columns, "_epoch").unionByName(self.parked())
        rows = self._one_per_key(rows, self.record_entity)
        # One pass: a record is loaded in this epoch, or parked with the epoch it came in.
        out = rows.join(known.withColumn("loaded", F.lit(True)), self.parent_ref, "left") \
            .withColumn("loaded", F.coalesce("loaded", F.lit(False))) \
            .withColumn("_epoch", F.when(F.col("loaded"), F.lit(epoch).cast("bigint")).otherwise(F.col("_epoch")))
        self._write(out.select(*self.record_entity.columns, "_epoch", "loaded"), f"records/epoch={epoch}", "loaded")
        self._commit("epoch", epoch)

    def _write(self, rows: DataFrame, to: str, *by: str) -> None:
        # Static: what an earlier, unfinished try left in this folder goes, whatever partitions it had.
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*by).parquet(f"{self.folder}/{to}")

    def compact(self) -> int | None:
        """Fold all committed epochs into one base; the epoch it reaches to.  Old files stay for readers that are under way."""
        last = max(self.committed(), default=None)
        if last is None or last in self._entries("base"):
            return last
        for name, entity in (("parents", self.parent_entity), ("records", self.record_entity)):
            rows = self._latest(name, entity).select(*entity.columns, "_epoch")
            self._write(rows.repartitionByRange(entity.key).sortWithinPartitions(entity.key), f"base/epoch={last}/{name}")
        self._commit("base", last)
        return last

    def run(self, stream: DataFrame, checkpoint: str):
        """Drain what has landed (``availableNow``); restartable from the checkpoint and the ledger."""
        q = stream.writeStream.foreachBatch(self.handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        q.awaitTermination()
        return q
