"""catalog_lake: a product-catalogue engine expressed as Spark DataFrame jobs.

Layout
------
sources/    readers and writers: entity JSONL, rounds, snapshots, allowlist, pages
functions/  Column -> Column scalars and row predicates (pure Catalyst, two pandas UDFs)
operators/  joins, aggregates, keep-one windows, ordering, set ops, upserts,
            page extraction, full-text postings
plans/      the served catalogue queries, the data-quality suite, dimension backfill
streaming/  frontier planning and Structured Streaming ingest / dedup / upsert
"""

from catalog_lake.session import get_spark, checkpoint_dir  # noqa: F401
from catalog_lake.binding import Catalog  # noqa: F401
