"""Key -> (Spark callable over a Catalog, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from catalog_lake.binding import with_views


@dataclass(frozen=True)
class Entry:
    key: str
    build: Callable[..., DataFrame]
    oracle: str | None


REGISTRY: dict[str, Entry] = {}


def register(key: str, oracle: str | None = None, views: tuple[str, ...] = ()):
    """Decorator: register ``fn(catalog) -> DataFrame`` under ``key``.

    ``views`` lists the catalogue views (``binding.ORACLE_VIEWS``) the oracle
    reads; they are prepended as CTEs so the string runs on the raw tables.
    """
    def deco(fn):
        if key in REGISTRY:
            raise KeyError(f"duplicate query key {key}")
        REGISTRY[key] = Entry(key, fn, with_views(oracle, *views) if oracle else None)
        return fn
    return deco
