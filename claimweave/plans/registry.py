"""Registry of queries exposed through ``__spark_entry__``.

Each query is ``fn(spark, sf_dir) -> DataFrame`` plus, where the semantics
are SQL-expressible, a DuckDB statement over the same parquet tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from claimweave.sources.tables import Tables


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None
    covers: str


REGISTRY: dict[str, Query] = {}


def query(name: str, covers: str, sql: str | None = None):
    def deco(fn: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql.strip() if sql else None, covers)
        return fn
    return deco


def runner(name: str) -> Callable[[SparkSession, str], DataFrame]:
    q = REGISTRY[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return q.build(Tables(spark, sf_dir))

    run.__name__ = f"run_{name}"
    return run
