"""Registry of named queries: each is a Spark callable ``(spark, sf_dir) -> DataFrame``
and, where the result is SQL-expressible, an equivalent SQL text for the DuckDB
oracle (tables: the driver's parquet views; derived views from
:mod:`tabforge.plans.fixtures`).

Doubles that two engines could compute in a different order are rounded to 6
decimals on both sides.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


_ROUND = re.compile(r"\bround\(", re.IGNORECASE)


def nudge_rounding(sql: str) -> str:
    """Apply the same 1e-9 rounding nudge as the Spark side (see functions.stats.rnd)."""
    return _ROUND.sub("round(1e-9 + ", sql)


def query(name: str, sql: str | None = None):
    if sql is not None:
        sql = nudge_rounding(sql)

    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def load_all() -> dict[str, tuple[QueryFn, str | None]]:
    # Importing the modules registers their queries.
    from . import (q_assoc, q_clean, q_encode, q_features, q_metrics, q_ml,  # noqa: F401
                   q_profile, q_select, q_sources, q_split)
    return REGISTRY
