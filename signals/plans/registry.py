"""Registered queries: one per operator id, each with an optional DuckDB oracle.

A query is ``fn(spark, sf_dir) -> DataFrame`` over the driver tables. The
oracle is SQL over the same tables, written from the operator's semantics,
not from our Spark code.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


def load_all() -> None:
    """Import every query module so its ``register`` calls run."""
    from signals.plans import (  # noqa: F401
        q_cases,
        q_detect,
        q_parse,
        q_schema,
        q_sources,
        q_tenancy,
        q_tail,
    )
