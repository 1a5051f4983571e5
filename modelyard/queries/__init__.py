"""Runnable queries on the benchmark tables, each with its SQL form where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MODULES = ("sources", "contracts", "splits", "metrics", "runs", "text", "drift", "scoring", "learning", "streams")


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple[str, ...]
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


_QUERIES: dict[str, Query] = {}


def query(name: str, covers: str, sql: str | None = None):
    """Register a function (spark, folder) -> DataFrame; ``covers`` lists survey rows."""

    def register(run):
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = Query(name, tuple(covers.split()), run, sql)
        return run

    return register


def all_queries() -> dict[str, Query]:
    for module in MODULES:
        import_module(f"modelyard.queries.{module}")
    return dict(_QUERIES)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that engines adding in another order agree."""
    return df.withColumns({c: F.round(c, digits) for c, t in df.dtypes if t == "double"})
