"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

A builder takes a ``Tables`` (lazy research tables of one data directory) and returns
a DataFrame; ``spark_query`` rounds its DOUBLE columns the same way the oracle text
does (``sqlkit.rnd``), so the two outputs can be hashed value for value.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.semantics import round_doubles
from tidemark.sources.tables import Tables


@dataclass
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None
    doc: str = ""


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql.strip() if sql else None, (fn.__doc__ or "").strip())
        return fn
    return deco


def load_all() -> dict[str, Query]:
    # import for registration side effects
    from tidemark.plans import (  # noqa: F401
        q_sources, q_clean, q_pod, q_fundamentals, q_factors, q_events, q_models, q_streaming, q_lake,
    )
    return REGISTRY


def spark_query(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    q = load_all()[name]
    return round_doubles(q.build(Tables(spark, sf_dir)))
