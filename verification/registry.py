"""Named queries and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from verification.fixtures import load, with_fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Inputs:
    """Tables and fixtures by attribute: ``t.part``, ``t.f_trails``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return load(self.spark, self.sf_dir, name)


def query(name: str, oracle: str | None = None):
    def add(build: Callable[[Inputs], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(Inputs(spark, sf_dir))
        if oracle is not None:
            ORACLES[name] = with_fixtures(oracle)
        return build

    return add
