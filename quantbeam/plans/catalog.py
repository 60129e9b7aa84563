"""Registry of checkable queries: name -> (Spark plan, DuckDB oracle SQL)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLE: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    """Cast DECIMAL columns to DOUBLE so results compare across engines."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            out.append(F.col(f"`{f.name}`").cast("double").alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)


def query(name: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = lambda spark, sf_dir, _fn=fn: portable(_fn(spark, sf_dir))
        if oracle is not None:
            _ORACLE[name] = oracle
        return fn
    return deco


def _load_all() -> None:
    # Importing the plan modules registers their queries.
    from quantbeam.plans import (q_ticks, q_tokens, q_indicators, q_summary,  # noqa: F401
                                 q_io)


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_ORACLE)
