"""Names, functions and oracle SQL of the registered queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tideline.session import pin

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Registered:
    run: Query
    sql: str | None


REGISTRY: dict[str, Registered] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(pin(spark), sf_dir)

        REGISTRY[function.__name__] = Registered(run, sql)
        return function

    return register
