"""Registry of queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from loomspark.session import apply_runtime_conf

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


@dataclass
class Tables:
    """The given tables, read lazily."""

    spark: SparkSession
    root: str

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``; ``sql`` is its DuckDB twin."""

    def add(fn):
        if name in QUERIES:
            raise KeyError(name)

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_runtime_conf(spark)
            return fn(Tables(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add
