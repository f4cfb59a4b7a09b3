"""Registry of queries and of the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from textwrap import dedent

from pyspark.sql import DataFrame, SparkSession

from tidewell.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Driver tables as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register a function of ``Tables`` under a name."""

    def register(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(tune(spark), folder))

        run.__name__ = name
        assert name not in QUERIES, name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = dedent(sql).strip()
        return fn

    return register
