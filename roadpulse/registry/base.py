"""Named queries over the driver's tables, each with an SQL text that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    """Round the named (default: all floating) columns for comparison across engines."""
    names = cols or [n for n, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({c: F.round(c, digits) for c in names})
