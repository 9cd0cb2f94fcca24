"""Keep-one dedup and numbering windows.

All keep-one operators are ``row_number() = 1`` over a window partitioned by
the key with a *total* order, so the survivor never depends on partitioning.
Spark plans them as one shuffle on the key plus a sort within partitions; a
hot key is sorted in its own partition (spills, does not fail).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalog_lake.functions.text import round_number


def _cols(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def keep_one(df: DataFrame, pk: str | Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the first by ``order`` (which should be total)."""
    keys = [pk] if isinstance(pk, str) else list(pk)
    w = Window.partitionBy(*keys).orderBy(*_cols(order))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def keep_round(df: DataFrame, pk: str | Sequence[str], round_col: str = "round_label",
               file_col: str | None = None, pos_col: str = "row_pos", policy: str = "newest") -> DataFrame:
    """Newest (or oldest) round wins; within a round the first row of the
    newest-named file, then the first row in the file.  Rounds order by their
    number, so ``r9`` is older than ``r10`` (the reference sorts text, quirk 5).
    A null key is one key, as in the reference's streaming dedup.
    """
    if policy not in ("newest", "oldest"):
        raise ValueError("policy is 'newest' or 'oldest'")
    rnum = round_number(round_col)
    order = [rnum.desc_nulls_last() if policy == "newest" else rnum.asc_nulls_last()]
    if file_col:
        order.append(F.col(file_col).desc() if policy == "newest" else F.col(file_col).asc())
    order.append(F.col(pos_col).asc())
    return keep_one(df, pk, order)


def dense_ids(values: DataFrame, col: str, id_col: str = "new_id") -> DataFrame:
    """``ROW_NUMBER() OVER (ORDER BY col)`` over the distinct non-null values, without gathering them.

    The values are range-partitioned and sorted, and a row's number is its place in its
    partition plus the rows of the partitions before.  Only one count per partition goes to
    the driver.  The sorted values are cut at a checkpoint in the shared folder first: range
    bounds come from a sample, and both passes must see the same ones.
    """
    from catalog_lake.session import checkpoint_dir
    checkpoint_dir(values.sparkSession)
    place = F.monotonically_increasing_id()  # partition number << 33, plus the place in it
    rows = values.select(col).filter(F.col(col).isNotNull()).distinct().sort(col).select(col, place.alias("_place")).checkpoint()
    part = F.shiftrightunsigned("_place", 33)
    counts = sorted(rows.groupBy(part.alias("_part")).count().collect())
    before, offsets = 0, []
    for p, n in counts:
        offsets.append((p, before))
        before += n
    offset = values.sparkSession.createDataFrame(offsets, "_part long, _before long")
    return rows.withColumn("_part", part).join(offset, "_part") \
        .select(col, (F.col("_place").bitwiseAND((1 << 33) - 1) + F.col("_before") + 1).alias(id_col))


def assign_ids(names: DataFrame, name_col: str, base: DataFrame | int, id_col: str = "new_id") -> DataFrame:
    """``base + ROW_NUMBER() OVER (ORDER BY name)`` over *distinct* names (quirk 3 fixed).

    ``base`` is a number or a one-row, one-column frame (e.g. the current
    maximum id), cross-joined in so the value never goes through the driver.
    Empty names get no id.  The numbers are ``dense_ids``: no task sees all names.
    """
    d = dense_ids(names.filter(F.col(name_col) != ""), name_col, "_id")
    if isinstance(base, DataFrame):
        d = d.crossJoin(base.select(F.col(base.columns[0]).alias("_base")))
    else:
        d = d.withColumn("_base", F.lit(base))
    return d.select(name_col, (F.col("_base") + F.col("_id")).cast("bigint").alias(id_col))


def drop_full_duplicates(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows identical on ``cols`` collapse to one (surrogate ids ignored)."""
    return df.dropDuplicates(list(cols))


def with_position(df: DataFrame, arr: str, value: str = "value", pos: str = "position",
                  keep: Sequence[str] = ()) -> DataFrame:
    """Explode an array with its 1-based element position."""
    return df.select(*keep, F.posexplode(arr).alias("_p", value)) \
        .withColumn(pos, (F.col("_p") + 1).cast("bigint")).drop("_p")


def first_per_page(df: DataFrame, page_col: str, key_col: str, pos_col: str) -> DataFrame:
    """First record per key within a page; blank keys dropped."""
    k = F.col(key_col).cast("string")
    return keep_one(df.filter(k.isNotNull() & (k != "")), [page_col, key_col], [pos_col])
