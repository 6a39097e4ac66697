"""Registry of the query catalogue: one Spark plan and (where SQL can say it) one DuckDB oracle per key.

Every query reads the whole driver tables under ``sf_dir`` (or frames Spark
derives from them). Doubles are rounded to 6 places on both sides; every
computed column carries the same alias in the plan and in the oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Decorator: add a (spark, sf_dir) -> DataFrame plan, with its oracle SQL."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query key {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from carepulse.plans import (  # noqa: F401
        q_results, q_encode, q_sources, q_train, q_evaluate, q_model, q_wide, q_stream,
    )
