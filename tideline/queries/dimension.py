"""Observed vendors, their history, and joins to it."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideline.operators.lookup import as_of_join, current_versions, lookup_with_fallback, point_in_time_join
from tideline.operators.quality import unmapped_report
from tideline.operators.scd2 import open_versions, present_dimension, scd2_apply
from tideline.operators.versions import create_database, replace_contents
from tideline.plans import trips as plan
from tideline.queries.feeds import TRIPS_SQL, VENDORS_SQL, raw_feeds, table, vendor_lookup
from tideline.queries.registry import query
from tideline.session import workspace

FIRST, SECOND = datetime(1998, 1, 1), datetime(2000, 1, 1)

# Names at the second look: vendors of nation 7 are renamed, vendors of nations above 12 now have a
# name even if every tenth had none.
_OBSERVED_SQL = """
lookup1 AS (SELECT s_suppkey AS id, s_name AS name FROM supplier WHERE s_suppkey % 10 <> 0),
lookup2 AS (
  SELECT s_suppkey AS id, CASE WHEN s_nationkey = 7 THEN s_name || ' Ltd' ELSE s_name END AS name
  FROM supplier WHERE s_suppkey % 10 <> 0 OR s_nationkey > 12
),
look1 AS (
  SELECT DISTINCT l_suppkey AS vendor_id, coalesce(name, 'Unknown vendor (' || l_suppkey || ')') AS vendor_name,
         name IS NULL AS is_unmapped
  FROM lineitem LEFT JOIN lookup1 ON l_suppkey = id WHERE l_shipdate < TIMESTAMP '1995-02-01'
),
look2 AS (
  SELECT DISTINCT l_suppkey AS vendor_id, coalesce(name, 'Unknown vendor (' || l_suppkey || ')') AS vendor_name,
         name IS NULL AS is_unmapped
  FROM lineitem LEFT JOIN lookup2 ON l_suppkey = id WHERE l_shipdate >= TIMESTAMP '1995-02-01'
),
history AS (
  SELECT a.*, TIMESTAMP '1998-01-01 00:00:00' AS valid_from,
         CASE WHEN b.vendor_name <> a.vendor_name THEN TIMESTAMP '2000-01-01 00:00:00' END AS valid_to
  FROM look1 a LEFT JOIN look2 b USING (vendor_id)
  UNION ALL
  SELECT b.*, TIMESTAMP '2000-01-01 00:00:00', NULL
  FROM look2 b LEFT JOIN look1 a USING (vendor_id)
  WHERE a.vendor_id IS NULL OR b.vendor_name <> a.vendor_name
),
dimension AS (
  SELECT md5(vendor_id || '|' || strftime(valid_from, '%Y-%m-%d %H:%M:%S')) AS vendor_key, vendor_id, vendor_name,
         is_unmapped, valid_from, coalesce(valid_to, TIMESTAMP '9999-12-31 00:00:00') AS valid_to,
         valid_to IS NULL AS is_current
  FROM history
)"""


def _look(spark: SparkSession, sf_dir: str, lines: DataFrame, second: bool) -> DataFrame:
    """Vendors met in `lines`, named by the lookup of that day."""
    suppliers = table(spark, sf_dir, "supplier")
    known, name = F.col("s_suppkey") % 10 != 0, F.col("s_name")
    if second:
        known = known | (F.col("s_nationkey") > 12)
        name = F.when(F.col("s_nationkey") == 7, F.concat(name, F.lit(" Ltd"))).otherwise(name)
    lookup = suppliers.where(known).select(F.col("s_suppkey").alias("vendor_id"), name.alias("vendor_name"))
    met = lines.select(F.col("l_suppkey").alias("vendor_id")).distinct()
    return lookup_with_fallback(
        met, lookup, "vendor_id", "vendor_id", "vendor_name", "vendor_name", "vendor", flag="is_unmapped"
    )


def vendor_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two looks at the vendors: the second finds new ones, renamed ones, and misses some."""
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate")
    early = lines.where(F.col("l_shipdate") < F.lit("1995-02-01").cast("timestamp_ntz"))
    later = lines.where(F.col("l_shipdate") >= F.lit("1995-02-01").cast("timestamp_ntz"))
    history = open_versions(_look(spark, sf_dir, early, second=False), "vendor_id", FIRST)
    return scd2_apply(history, _look(spark, sf_dir, later, second=True), "vendor_id", ["vendor_name"], SECOND)


def stored_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension as a table: history cannot be derived again, and joins know its size."""
    database = create_database(spark, "dim_" + workspace(spark, "d")[-12:], workspace(spark, "dimension"))
    dimension = present_dimension(vendor_history(spark, sf_dir), "vendor_id", "vendor_key")
    replace_contents(spark, f"{database}.vendor", dimension)
    return spark.table(f"{database}.vendor")


_OBSERVED_KEYS_SQL = f"""
    WITH {TRIPS_SQL}, {VENDORS_SQL}
    SELECT t.vendor_id, coalesce(any_value(vendor_name), 'Unknown vendor (' || t.vendor_id || ')') AS vendor_name,
           any_value(vendor_name) IS NULL AS is_unmapped, min(pickup_at) AS first_seen_at,
           max(pickup_at) AS last_seen_at, count(*) AS trip_count
    FROM trips t LEFT JOIN vendors v ON t.vendor_id = v.vendor_id
    WHERE t.vendor_id IS NOT NULL GROUP BY t.vendor_id
    """


@query(_OBSERVED_KEYS_SQL)
def observed_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = plan.all_trips(*raw_feeds(spark, sf_dir, locations=False))
    return plan.observed_vendors(trips, vendor_lookup(spark, sf_dir))


@query(_OBSERVED_KEYS_SQL)
def observed_keys_in_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The observations of the months before 2000 are stored; the later months are added to them."""
    trips = plan.all_trips(*raw_feeds(spark, sf_dir, locations=False))
    vendors = vendor_lookup(spark, sf_dir)
    folder = workspace(spark, "observed")
    plan.observed_vendors(trips.where("source_period < '2000-01'"), vendors).write.parquet(folder)
    return plan.observed_vendors(trips.where("source_period >= '2000-01'"), vendors, spark.read.parquet(folder))


@query(
    f"""
    WITH {VENDORS_SQL}
    SELECT l_suppkey AS vendor_id, 'Unknown vendor (' || l_suppkey || ')' AS vendor_name, count(*) AS trip_count
    FROM lineitem WHERE l_suppkey NOT IN (SELECT vendor_id FROM vendors) GROUP BY l_suppkey
    """
)
def unmapped_vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = plan.all_trips(*raw_feeds(spark, sf_dir, locations=False))
    unmapped = unmapped_report(plan.observed_vendors(trips, vendor_lookup(spark, sf_dir)))
    return unmapped.select("vendor_id", "vendor_name", "trip_count")


@query(f"WITH {_OBSERVED_SQL} SELECT vendor_id, vendor_name, is_unmapped, valid_from, valid_to FROM history")
def scd2_two_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vendor_history(spark, sf_dir).drop("version_key")


@query(f"WITH {_OBSERVED_SQL} SELECT * FROM dimension")
def vendor_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present_dimension(vendor_history(spark, sf_dir), "vendor_id", "vendor_key")


@query(
    f"""
    WITH {_OBSERVED_SQL}
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
           coalesce(vendor_name, 'Unknown vendor (' || l_suppkey || ')') AS vendor_name
    FROM lineitem LEFT JOIN (SELECT * FROM dimension WHERE is_current) d ON l_suppkey = vendor_id
    """
)
def current_version_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    current = current_versions(stored_dimension(spark, sf_dir))
    return lookup_with_fallback(lines, current, "l_suppkey", "vendor_id", "vendor_name", "vendor_name", "vendor")


@query(
    f"""
    WITH {_OBSERVED_SQL}
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, vendor_key, vendor_name
    FROM lineitem LEFT JOIN dimension ON l_suppkey = vendor_id AND l_shipdate >= valid_from AND l_shipdate < valid_to
    """
)
def point_in_time_version_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
        F.col("l_shipdate").cast("timestamp").alias("moment"),
    )
    values = {"vendor_key": "vendor_key", "vendor_name": "vendor_name"}
    joined = point_in_time_join(lines, stored_dimension(spark, sf_dir), "l_suppkey", "vendor_id", "moment", values)
    return joined.drop("moment")


_PRICE_LISTS_SQL = """
lists AS (
  SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS orders FROM orders GROUP BY 1
), versions AS (
  SELECT orders, CAST(day AS TIMESTAMP) AS valid_from,
         coalesce(CAST(lead(day) OVER (ORDER BY day) AS TIMESTAMP), TIMESTAMP '9999-12-31 00:00:00') AS valid_to
  FROM lists
)"""


@query(
    f"""
    WITH {_PRICE_LISTS_SQL}
    SELECT l_orderkey, l_linenumber, l_shipdate, valid_from AS list_from, orders AS list_orders
    FROM lineitem LEFT JOIN versions ON l_shipdate >= valid_from AND l_shipdate < valid_to
    """
)
def as_of_many_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line meets one of over a thousand daily versions of the one list that all lines share."""
    days = table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("orders"))
    opened = days.select(F.lit(1).alias("list"), F.col("day").cast("timestamp").alias("valid_from"), "orders")
    ends = F.lead("valid_from").over(Window.partitionBy("list").orderBy("valid_from"))  # a row per day
    versions = opened.withColumn("valid_to", F.coalesce(ends, F.lit("9999-12-31").cast("timestamp"))).withColumn("list_from", F.col("valid_from"))
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", F.col("l_shipdate").cast("timestamp").alias("moment"), F.lit(1).alias("list")
    )
    values = {"list_from": "list_from", "orders": "list_orders"}
    return as_of_join(lines, versions, "list", "list", "moment", values, rows_per_group=20_000).drop("moment", "list")
