"""Registered queries: one Spark callable and (when SQL can say it) one DuckDB oracle each.

Keys are ``<survey id>_<slug>``.  Every callable reads the whole driver tables
(through ``Catalog``) so its work grows with the scale factor.
"""

from catalog_lake.queries.registry import REGISTRY, register  # noqa: F401


def load_all() -> None:
    """Import every registration module (idempotent)."""
    from catalog_lake.queries import (  # noqa: F401
        q_navigation, q_scalars, q_relational, q_quality, q_rounds, q_search, q_extract, q_incremental)
