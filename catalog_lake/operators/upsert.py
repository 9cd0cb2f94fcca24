"""Keyed table maintenance on plain Parquet.

No table format is installed, so a keyed table is a Parquet directory and an
upsert is a new snapshot: ``keep_one(source) ∪ (target ⋉̸ source)``.  The
result is written to a fresh directory (never the one being read) and the
caller swaps the pointer — see ``sources.snapshots.publish``.  Every
operation here is idempotent: applying the same source twice gives the same
table as applying it once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalog_lake.functions.text import to_int, to_text
from catalog_lake.operators.dedup import keep_one


def _keys(pk: str | Sequence[str]) -> list[str]:
    return [pk] if isinstance(pk, str) else list(pk)


def upsert(target: DataFrame, source: DataFrame, pk: str | Sequence[str],
           order: Sequence[Column | str] | None = None) -> DataFrame:
    """K1: incoming rows replace all non-key columns of existing keys; new keys are added.

    The batch is cut to one row per key (the first by ``order``; default every
    non-key column, a deterministic survivor, W7; a hot key is cut map-side by
    the window group limit) and the target keeps the rows whose key is not in it.
    A small batch is broadcast by AQE, and the target then stays where it is:
    no shuffle, no sort.  Source rows with a null key are dropped (F13); target
    rows are never collapsed.
    """
    keys = _keys(pk)
    cols = target.columns
    ordering = list(order) if order is not None else [c for c in source.columns if c not in keys]
    ordering = [F.col(c) if isinstance(c, str) else c for c in ordering]
    not_null = F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    new = keep_one(source.filter(not_null).select(*cols), keys, ordering)
    return target.join(new.select(*keys), keys, "left_anti").select(*cols).unionByName(new)


def insert_missing(target: DataFrame, source: DataFrame, pk: str | Sequence[str]) -> DataFrame:
    """K2: ``INSERT … ON CONFLICT DO NOTHING``: only keys absent from the target are added."""
    keys = _keys(pk)
    new = source.join(target.select(*keys), keys, "left_anti")
    return target.unionByName(new.select(*target.columns))


COMPAT_FIELDS = ["car_type_id", "model_series_id", "manufacturer_name", "model_name", "engine_or_variant",
                 "year_from", "year_to", "extra_qualifier"]


def explode_compat(details: DataFrame, array_col: str = "compatible_cars") -> DataFrame:
    """K3: one typed row per compatible-car element; ids leniently parsed, text blanks filled."""
    e = details.select("article_id", F.explode(array_col).alias("c"))
    cols = [to_int(F.col("c.car_type_id")).alias("car_type_id"),
            to_int(F.col("c.model_series_id")).alias("model_series_id")]
    cols += [to_text(F.col(f"c.{f}")).alias(f) for f in COMPAT_FIELDS[2:]]
    return e.select("article_id", *cols)


def replace_children(children: DataFrame, incoming: DataFrame, fk: str, parents: DataFrame | None = None) -> DataFrame:
    """K4: drop every child of the loaded parents, then add the incoming children.

    ``parents`` lists the loaded parents' keys, so one that comes with no children loses
    its old ones; without it, the parents are those of the incoming children.
    """
    parents = (incoming if parents is None else parents).select(fk).distinct()
    return children.join(parents, fk, "left_anti").unionByName(incoming.select(*children.columns))


def fill_nulls_from(target: DataFrame, sub: DataFrame, key: str, col: str) -> DataFrame:
    """K5: ``UPDATE … SET col = sub.col FROM sub WHERE key matches AND col IS NULL``."""
    s = sub.select(key, F.col(col).alias("_fill"))
    return target.join(s, key, "left").withColumn(col, F.coalesce(F.col(col), F.col("_fill"))).drop("_fill") \
        .select(*target.columns)


def latest_per_key(log: DataFrame, key: str, ts: str, tie: str | None = None) -> DataFrame:
    """K6: the last write per key (``INSERT OR REPLACE``): ``max_by`` over (ts, tie).

    A partial aggregate per partition before the shuffle: a hot url's rows
    are folded map-side, so skew does not reach the reducer.
    """
    order = F.struct(F.col(ts), F.col(tie)) if tie else F.col(ts)
    others = [c for c in log.columns if c != key]
    return (log.groupBy(key).agg(F.max_by(F.struct(*others), order).alias("_last"))
            .select(key, *[F.col(f"_last.{c}").alias(c) for c in others]))
