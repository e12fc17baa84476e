"""Name to Spark query, name to oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from suite import fixtures


class Tables:
    """The driver's tables and the views derived from them, by name."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir

    def __getitem__(self, name: str) -> DataFrame:
        return fixtures.load(self.spark, self.sf_dir, name)

    def some(self, *names: str) -> dict[str, DataFrame]:
        return {n: self[n] for n in names}


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, views: str = "", sql: str | None = None):
    """Register a query over ``Tables``, with its oracle over the named views."""

    def add(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = fixtures.with_views(views.split(), sql)
        return build

    return add
