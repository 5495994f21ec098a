"""Names of all queries, with SQL that gives the same rows."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.plans import scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None, ctes: str = ""):
    """Register a function (spark, sf_dir) -> DataFrame under its own name; ``ctes`` go before ``sql``."""

    def add(f):
        QUERIES[f.__name__] = scratch.tidy(f)
        if sql is not None:
            ORACLE[f.__name__] = f"WITH RECURSIVE {ctes}\n{sql}" if ctes else sql
        return f

    return add


def load() -> None:
    """Import all catalogues, which register their queries. Whoever wants the whole list calls this first."""
    for name in ("basic", "graph", "service", "profiles", "tables"):
        importlib.import_module(f"ledgerlens.plans.catalogue_{name}")
