"""Conformed feeds, keys, time attributes and the zone reference."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions import duration_minutes, local_parts, local_to_instant, surrogate_key
from tideline.plans import trips as plan
from tideline.queries.feeds import TRIPS_SQL, instant_sql, key_sql, raw_feeds, table
from tideline.queries.registry import query

STAND_IN_SENTINELS = (23, 24)


@query(f"WITH {TRIPS_SQL} SELECT * FROM trips")
def conformed_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.all_trips(*raw_feeds(spark, sf_dir))


@query(
    f"""
    SELECT {key_sql("CASE l_linestatus WHEN 'F' THEN 'yellow' ELSE 'green' END", "l_orderkey", "l_linenumber",
                    "l_suppkey", "l_partkey", "l_shipdate")} AS line_key,
           l_linestatus, strftime(l_shipdate, '%Y-%m') AS source_period
    FROM lineitem
    """
)
def feed_surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = F.when(F.col("l_linestatus") == "F", "yellow").otherwise("green")
    key = surrogate_key([feed, "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_shipdate"])
    return table(spark, sf_dir, "lineitem").select(
        key.alias("line_key"), "l_linestatus", F.date_format("l_shipdate", "yyyy-MM").alias("source_period")
    )


@query(
    f"""
    WITH clocks AS (
      SELECT event_id, ts AS started, ts + to_seconds(value) AS ended FROM events
    ), instants AS (
      SELECT event_id, started, {instant_sql("started")} AS started_at, {instant_sql("ended")} AS ended_at FROM clocks
    )
    SELECT event_id, started_at, CAST(started AS DATE) AS started_date,
           CAST(hour(started) AS INTEGER) AS started_hour, CAST(dayofweek(started) + 1 AS INTEGER) AS started_day_of_week,
           round((floor(epoch_us(ended_at) / 1000000.0) - floor(epoch_us(started_at) / 1000000.0)) / 60.0, 6) AS minutes
    FROM instants
    """
)
def local_time_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    started = F.col("ts")
    ended = F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("value").cast("decimal(18,6)"))
    clock = local_parts(started)
    instants = table(spark, sf_dir, "events").select(
        "event_id",
        local_to_instant(started, plan.ZONE).alias("started_at"),
        local_to_instant(ended, plan.ZONE).alias("ended_at"),
        *[column.alias(f"started_{name}") for name, column in clock.items()],
    )
    return instants.withColumn("minutes", duration_minutes(F.col("started_at"), F.col("ended_at"))).drop("ended_at")


@query(
    """
    SELECT CAST(n_nationkey AS BIGINT) AS location_id, r_name AS borough, n_name AS zone_name,
           'Zone ' || n_nationkey AS service_zone, n_nationkey IN (23, 24) AS is_unknown_zone,
           TIMESTAMP '2025-01-01 00:00:00' AS loaded_at
    FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
    """
)
def zone_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.zone_reference(raw_zones(spark, sf_dir), STAND_IN_SENTINELS)


def raw_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = table(spark, sf_dir, "region")
    zones = table(spark, sf_dir, "nation").join(regions, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return zones.select(
        F.col("n_nationkey").alias("locationid"),
        F.col("r_name").alias("borough"),
        F.col("n_name").alias("zone"),
        F.concat(F.lit("Zone "), F.col("n_nationkey").cast("string")).alias("service_zone"),
        F.lit("2025-01-01 00:00:00").cast("timestamp").alias("_loaded_at"),
    )
