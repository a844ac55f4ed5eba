"""Registration of named queries and, where SQL can say the same, their SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


class Tables:
    """Tables of one folder by attribute: ``t.lineitem``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(os.path.join(self.folder, f"{name}.parquet"))


def query(name: str, sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Query]:
    """Register ``fn(tables)`` as query ``name``."""

    def register(fn: Callable[[Tables], DataFrame]) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(spark, folder))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register
