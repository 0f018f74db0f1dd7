"""The fact, and the lookups on their own."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators.aggregate import rows_per_period
from tideline.operators.lookup import lookup_with_fallback
from tideline.operators.scd2 import open_versions, present_dimension
from tideline.plans import trips as plan
from tideline.queries.feeds import CODES_SQL, TRIPS_SQL, VENDORS_SQL, code_lists, raw_feeds, table, vendor_lookup
from tideline.queries.registry import query

AS_OF = datetime(2002, 1, 1)
ACTOR = "loader"

ENRICHED_SQL = f"""{TRIPS_SQL}, {VENDORS_SQL}, {CODES_SQL},
fact AS (
  SELECT trip_key, tlc_type, t.vendor_id,
         coalesce(vendor_name, 'Unknown vendor (' || t.vendor_id || ')') AS vendor_name,
         t.rate_code_id,
         coalesce(rate_code_description, 'Unknown rate code (' || t.rate_code_id || ')') AS rate_code_description,
         t.payment_type,
         coalesce(payment_type_description, 'Unknown payment type (' || t.payment_type || ')') AS payment_type_description,
         t.trip_type,
         coalesce(trip_type_description, 'Unknown trip type (' || t.trip_type || ')') AS trip_type_description,
         pickup_location_id, dropoff_location_id, pickup_at, dropoff_at, pickup_at_local, dropoff_at_local,
         CAST(pickup_at_local AS DATE) AS pickup_date, CAST(hour(pickup_at_local) AS INTEGER) AS pickup_hour,
         CAST(dayofweek(pickup_at_local) + 1 AS INTEGER) AS pickup_day_of_week,
         round((epoch(dropoff_at) - epoch(pickup_at)) / 60.0, 6) AS trip_duration_minutes,
         passenger_count, trip_distance_miles, fare_amount, extra_amount, mta_tax_amount, tip_amount, tolls_amount,
         improvement_surcharge, congestion_surcharge, cbd_congestion_fee, airport_fee, ehail_fee, total_amount,
         store_and_forward_flag, source_period, source_file, loaded_at,
         TIMESTAMP '2002-01-01 00:00:00' AS updated_at, 'loader' AS updated_by
  FROM trips t
  LEFT JOIN vendors v ON t.vendor_id = v.vendor_id
  LEFT JOIN rate_codes r ON t.rate_code_id = r.rate_code_id
  LEFT JOIN payment_types p ON t.payment_type = p.payment_type
  LEFT JOIN trip_types y ON t.trip_type = y.trip_type
)"""


def vendor_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vendors of the lookup, all open since the first day."""
    named = vendor_lookup(spark, sf_dir).withColumn("is_unmapped", F.lit(False))
    return present_dimension(open_versions(named, "vendor_id", datetime(1995, 1, 1)), "vendor_id", "vendor_key")


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = plan.all_trips(*raw_feeds(spark, sf_dir))
    return plan.trip_fact(trips, vendor_dimension(spark, sf_dir), *code_lists(spark), AS_OF, ACTOR)


@query(f"WITH {ENRICHED_SQL} SELECT * FROM fact")
def fact_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched(spark, sf_dir)


@query(
    f"""
    WITH {ENRICHED_SQL}
    SELECT source_period, tlc_type, vendor_name, count(*) AS trips, min(pickup_at) AS first_pickup_at,
           max(trip_duration_minutes) AS longest_minutes
    FROM fact GROUP BY source_period, tlc_type, vendor_name
    """
)
def fact_by_period_and_vendor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        enriched(spark, sf_dir)
        .groupBy("source_period", "tlc_type", "vendor_name")
        .agg(
            F.count(F.lit(1)).alias("trips"),
            F.min("pickup_at").alias("first_pickup_at"),
            F.max("trip_duration_minutes").alias("longest_minutes"),
        )
    )


_LABELS_SQL = f"""
    WITH {VENDORS_SQL}
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           coalesce(vendor_name, 'Unknown vendor (' || l_suppkey || ')') AS vendor_name,
           vendor_name IS NULL AS is_unmapped
    FROM lineitem LEFT JOIN vendors ON l_suppkey = vendor_id
    """


@query(_LABELS_SQL)
def lookup_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return lookup_with_fallback(
        lines, vendor_lookup(spark, sf_dir), "l_suppkey", "vendor_id", "vendor_name", "vendor_name", "vendor",
        flag="is_unmapped",
    )


@query(_LABELS_SQL)
def lookup_labels_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lookup with the hot vendors spread by hand, as for a side too large to broadcast."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return lookup_with_fallback(
        lines, vendor_lookup(spark, sf_dir), "l_suppkey", "vendor_id", "vendor_name", "vendor_name", "vendor",
        flag="is_unmapped", salt_by="l_orderkey",
    )


@query(
    """
    SELECT strftime(l_shipdate, '%Y-%m') AS period, count(*) AS row_count
    FROM lineitem GROUP BY 1 ORDER BY 1 DESC LIMIT 12
    """
)
def rows_per_period_top12(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(F.date_format("l_shipdate", "yyyy-MM").alias("period"))
    return rows_per_period(lines)
