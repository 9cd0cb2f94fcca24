"""Joins, aggregations and set operations.

Physical join choice is left to Catalyst + AQE (broadcast when the runtime
size of a side is under ``spark.sql.autoBroadcastJoinThreshold``, sort-merge
otherwise, skewed partitions split).  The helpers below only express *what*
is joined; anti/semi joins are used wherever the reference writes
``LEFT JOIN … IS NULL``, ``NOT IN`` or ``IN (SELECT …)``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalog_lake.functions.text import pct


# -- joins ----------------------------------------------------------------
def orphans(child: DataFrame, parent: DataFrame, fk: str | Sequence[str], pk: str | Sequence[str] | None = None) -> DataFrame:
    """Child rows whose foreign key has no parent (left anti join).

    A null foreign key is an orphan too (it matches nothing), unlike
    ``NOT IN`` which returns nothing when the subquery has a null.
    """
    fks = [fk] if isinstance(fk, str) else list(fk)
    pks = fks if pk is None else ([pk] if isinstance(pk, str) else list(pk))
    p = parent.select(*[F.col(a).alias(b) for a, b in zip(pks, fks)])
    return child.join(p, fks, "left_anti")


def with_parent(child: DataFrame, parent: DataFrame, fk: str) -> tuple[DataFrame, DataFrame]:
    """(children whose parent exists, one-row frame with the skipped count)."""
    keys = parent.select(fk)
    kept = child.join(keys, fk, "left_semi")
    skipped = child.join(keys, fk, "left_anti").agg(F.count(F.lit(1)).alias("skipped"))
    return kept, skipped


def count_by_key(df: DataFrame, key: str, name: str) -> DataFrame:
    """Per-key row count, to be left-joined (correlated scalar subquery decorrelated)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def with_count(parent: DataFrame, child: DataFrame, key: str, name: str) -> DataFrame:
    """Parent rows with the number of matching child rows (0 when none)."""
    return parent.join(count_by_key(child, key, name), key, "left") \
        .withColumn(name, F.coalesce(F.col(name), F.lit(0)))


def having_match(df: DataFrame, other: DataFrame, key: str, cond: Column | None = None) -> DataFrame:
    """``key IN (SELECT DISTINCT key FROM other WHERE cond)`` as a left semi join."""
    o = other if cond is None else other.filter(cond)
    return df.join(o.select(key), key, "left_semi")


def unnest(df: DataFrame, col: str, alias: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Lateral unnest of an array column (rows with null/empty arrays vanish, as in SQL)."""
    return df.select(*keep, F.explode(col).alias(alias))


def coverage(parent: DataFrame, key: str, children: Mapping[str, DataFrame]) -> DataFrame:
    """Per child table, distinct parents that have a child and the percentage.

    The reference's double LEFT JOIN multiplies rows before counting
    distinct; semi joins give the same numbers without the fan-out.
    """
    base = parent.select(key).distinct()
    total = base.agg(F.count(F.lit(1)).alias("total"))
    out = total
    for name, ch in children.items():
        n = base.join(ch.select(key), key, "left_semi").agg(F.count(F.lit(1)).alias(f"with_{name}"))
        out = out.crossJoin(n)  # one row x one row
    for name in children:
        out = out.withColumn(f"pct_with_{name}", pct(F.col(f"with_{name}"), F.col("total")))
    return out


def tree_integrity(edges: Sequence[tuple[str, DataFrame, DataFrame, str, str]]) -> DataFrame:
    """One row per parent-child edge with the orphan count (one anti join per edge).

    ``edges`` = (edge name, child df, parent df, child fk column, parent key column).
    """
    out = None
    for name, child, parent, fk, pk in edges:
        n = orphans(child.filter(F.col(fk).isNotNull()), parent, fk, pk).agg(F.count(F.lit(1)).alias("orphans"))
        row = n.select(F.lit(name).alias("edge"), "orphans")
        out = row if out is None else out.unionByName(row)
    return out


# -- aggregations ------------------------------------------------------------
def table_counts(tables: Mapping[str, DataFrame], label: str = "entity") -> DataFrame:
    """``UNION ALL`` of one labelled count per table."""
    return label_counts(tables, label)


def label_counts(frames: Mapping[str, DataFrame], label: str = "check") -> DataFrame:
    """One row (label, n) per frame, unioned."""
    out = None
    for name, df in frames.items():
        row = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias(label), "n")
        out = row if out is None else out.unionByName(row)
    return out


def distinct_counts(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """Exact (or approximate) distinct count of several columns in one pass."""
    f = (lambda c: F.approx_count_distinct(c)) if approx else (lambda c: F.countDistinct(c))
    return df.agg(*[f(c).alias(f"distinct_{c}") for c in cols])


def duplicates(df: DataFrame, keys: Sequence[str], top: int | None = None) -> DataFrame:
    """Keys occurring more than once with their count (optionally the top n)."""
    d = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    if top is not None:
        d = d.orderBy(F.desc("n"), *keys).limit(top)
    return d


def blank_counts(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Conditional counts (``COUNT(*) FILTER (WHERE …)``) over one scan."""
    return df.agg(*[F.count_if(c).cast("bigint").alias(n) for n, c in checks.items()])


def share_of_total(df: DataFrame, col: str, digits: int = 1) -> DataFrame:
    """Count per value and its share of all rows.

    The grand total is a one-row aggregate cross-joined to the groups, not an
    un-partitioned window, so no step moves all groups into one task.
    """
    g = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    total = g.agg(F.sum("count").alias("_total"))
    return g.crossJoin(total).withColumn("pct", pct(F.col("count"), F.col("_total"), digits)).drop("_total")


def distinct_sorted(df: DataFrame, col: str, nonempty: bool = True) -> DataFrame:
    """Distinct values, optionally non-empty, ordered."""
    d = df.select(col)
    if nonempty:
        d = d.filter(F.col(col) != "")
    return d.distinct().orderBy(col)


def status_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per status."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def max_id(df: DataFrame, col: str) -> Column:
    """``COALESCE(MAX(col), 0)`` as an aggregate expression."""
    return F.coalesce(F.max(col), F.lit(0))


def missing_names(names: DataFrame, name_col: str, dim: DataFrame, dim_col: str,
                  count_col: str, top: int = 10) -> DataFrame:
    """Names absent from a dimension, ranked by distinct ``count_col`` (J6 + G2 + T3)."""
    miss = names.filter(F.col(name_col).isNotNull()).join(
        dim.select(F.col(dim_col).alias(name_col)), name_col, "left_anti")
    return (miss.groupBy(name_col).agg(F.countDistinct(count_col).alias("n"))
            .orderBy(F.desc("n"), name_col).limit(top))


# -- set operations ----------------------------------------------------------
def union_rounds(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of rounds by column name, missing columns null."""
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def new_keys(df: DataFrame, seen: DataFrame, pk: str) -> DataFrame:
    """Rows whose key is not in ``seen`` (set difference as an anti join)."""
    return df.join(seen.select(pk), pk, "left_anti")


def union_flagged(regular: DataFrame, oem: DataFrame, flag: str = "is_oem") -> DataFrame:
    """U4: regular and OEM lists with the flag set from the list they came from."""
    return regular.withColumn(flag, F.lit(False)).unionByName(oem.withColumn(flag, F.lit(True)))


def first_seen(df: DataFrame, pk: str, order_col: str) -> DataFrame:
    """Per key, the smallest ``order_col`` value it appears with."""
    return df.groupBy(pk).agg(F.min(order_col).alias("first_" + order_col))


