"""Registered queries of this subpackage: name -> (spark, folder) -> DataFrame, and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from textwrap import dedent

from pyspark.sql import DataFrame, SparkSession

from vitalgrid.session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(tune(spark), folder.rstrip("/"))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = dedent(sql).strip()
        return fn

    return keep


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
