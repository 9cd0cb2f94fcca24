"""Rounds -> keyed tables: the load cycle.

For every entity in dependency order: read all rounds, keep the newest
record per key, keep details only when their article exists (the skipped
ones are simply retried by the next load), upsert into the live snapshot,
write a new snapshot version and publish it.  Compatible cars are the
exploded children of the loaded details and replace the previous children of
those articles.  Loading the same rounds twice gives the same tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from catalog_lake.operators.relational import with_parent
from catalog_lake.operators.upsert import explode_compat, replace_children, upsert
from catalog_lake.sources import rounds as rs
from catalog_lake.sources.schemas import PRIMARY_KEYS

PROVENANCE = ["entity_type", "crawl_date", "round_no", "_file", "_row"]


def _incoming(spark: SparkSession, rounds_root: str, entity: str, policy: str) -> tuple[DataFrame, Observation] | None:
    """The newest record per key, and the counts that its own scan of the rounds will have made."""
    if not rs._exists(spark, f"{rounds_root.rstrip('/')}/entity_type={entity}"):
        return None
    pk = PRIMARY_KEYS[entity]
    r, seen = rs.counted(rs.read_rounds(spark, rounds_root, entity), pk)
    r = r.filter(F.col(pk).isNotNull())
    return rs.dedup_rounds(r, pk, policy).drop(*[c for c in PROVENANCE if c in r.columns]), seen


def _publish(spark: SparkSession, df: DataFrame, lake_root: str, entity: str, pk: str | tuple) -> int:
    keys = (pk,) if isinstance(pk, str) else pk
    path = rs.write_snapshot(df, lake_root, entity, keys)
    rs.publish(spark, path)
    return spark.read.parquet(path).count()


def load_rounds(spark: SparkSession, rounds_root: str, lake_root: str, policy: str = "newest") -> DataFrame:
    """Load every entity found under ``rounds_root`` into the snapshots under ``lake_root``.

    Returns (entity, status, rows, skipped, skipped_files, keyless) per entity: details
    whose article is missing, files that gave no row, and records without a key.
    """
    out = []
    for entity in rs.LOAD_ORDER:
        found = _incoming(spark, rounds_root, entity, policy)
        if found is None:
            out.append((entity, "missing", 0, 0, 0, 0))
            continue
        inc, seen = found
        pk = PRIMARY_KEYS[entity]
        skipped = 0
        if entity == "article_details":
            parents = rs.current(spark, lake_root, "articles")
            if parents is not None:
                inc, sk = with_parent(inc, parents.select("article_id"), "article_id")
                skipped = int(sk.first()[0])
        cur = rs.current(spark, lake_root, entity)
        new = inc if cur is None else upsert(cur, inc.select(*cur.columns), pk)
        rows = _publish(spark, new, lake_root, entity, pk)
        lost = len(rs.listed_files(spark, rounds_root, entity)) - seen.get["files"]
        out.append((entity, "loaded", rows, skipped, lost, seen.get["keyless"]))
        if entity == "article_details" and "compatible_cars" in inc.columns:
            children = explode_compat(inc)
            old = rs.current(spark, lake_root, "compatible_cars")
            merged = children if old is None else replace_children(old, children, "article_id", inc)
            out.append(("compatible_cars", "loaded",
                        _publish(spark, merged, lake_root, "compatible_cars", ("article_id", "car_type_id")), 0, 0, 0))
    return spark.createDataFrame(out, "entity string, status string, rows long, skipped long, skipped_files long, keyless long")
