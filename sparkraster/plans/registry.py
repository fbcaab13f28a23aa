"""Named queries over the input tables, and the SQL that checks them."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

MODULES = ("pixel_queries", "tile_queries", "metric_queries", "spatial_queries", "neighbourhood_queries", "run_queries")

_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a function under its name, with the DuckDB SQL of the same result."""

    def register(f: Query) -> Query:
        _queries[f.__name__] = f
        if sql:
            _oracles[f.__name__] = sql
        return f

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """``df`` with all doubles rounded, as the SQL rounds them."""
    return df.withColumns({c: F.round(c, digits) for c, kind in df.dtypes if kind == "double"})


def _load() -> None:
    for name in MODULES:
        importlib.import_module(f"sparkraster.plans.{name}")


def queries() -> dict[str, Query]:
    _load()
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_oracles)
