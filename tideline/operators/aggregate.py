"""The aggregates of the load, the dimension input and the checks.

All combine on the map side, so one key with a large share of the rows is no hot spot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def observe_keys(df: DataFrame, key: str, moment: str) -> DataFrame:
    """First and last moment and row count of every non-NULL key."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.min(moment).alias("first_seen_at"),
            F.max(moment).alias("last_seen_at"),
            F.count(F.lit(1)).alias("trip_count"),
        )
    )


def combine_observations(earlier: DataFrame, later: DataFrame, key: str) -> DataFrame:
    """Observations of earlier and of newly loaded rows as one.

    With the earlier ones stored, a run aggregates the rows of its new batches only.
    """
    return sum_observations(earlier.unionByName(later), key)


def sum_observations(observations: DataFrame, key: str) -> DataFrame:
    """Several observations of a key as one."""
    return (
        observations.groupBy(key)
        .agg(
            F.min("first_seen_at").alias("first_seen_at"),
            F.max("last_seen_at").alias("last_seen_at"),
            F.sum("trip_count").alias("trip_count"),
        )
    )


def rows_per_period(df: DataFrame, period: str = "period", newest: int | None = 12) -> DataFrame:
    """Row count per period, newest periods first; `newest=None` for all of them."""
    counts = df.groupBy(F.col(period).alias("period")).agg(F.count(F.lit(1)).alias("row_count"))
    ordered = counts.orderBy(F.desc("period"))
    return ordered if newest is None else ordered.limit(newest)


def max_or_default(df: DataFrame, column: str, default: str, output: str = "high_mark") -> DataFrame:
    """Largest value, or `default` for an empty input; always one row."""
    return df.agg(F.coalesce(F.max(column), F.lit(default)).alias(output))


def more_than_one(df: DataFrame, key: str, output: str = "versions") -> DataFrame:
    """Keys that occur more than once."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias(output))
    return counts.where(F.col(output) > 1)


def schema_shapes(fingerprints: DataFrame) -> DataFrame:
    """The distinct schema hashes of each dataset, sorted."""
    return fingerprints.groupBy("dataset").agg(
        F.array_sort(F.collect_set("schema_hash")).alias("schema_hashes")
    )
