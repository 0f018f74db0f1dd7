"""Contracts and data tests, with their failing rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.frames import small_frame
from tideline.functions import surrogate_key
from tideline.operators import quality
from tideline.operators.contract import null_violations, schema_differences
from tideline.operators.versions import create_database
from tideline.plans import trips as plan
from tideline.queries.dimension import _OBSERVED_SQL, vendor_history
from tideline.queries.conform import raw_zones
from tideline.queries.enrich import ENRICHED_SQL, enriched
from tideline.queries.feeds import TRIPS_SQL, VENDORS_SQL, key_sql, raw_feeds, table, vendor_lookup
from tideline.queries.registry import query
from tideline.session import workspace

_SHORT_KEY = ["l_orderkey", "l_linenumber"]


@query(
    f"""
    SELECT {key_sql(*_SHORT_KEY)} AS short_key, count(*) AS occurrences FROM lineitem GROUP BY 1 HAVING count(*) > 1
    """
)
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key of too few columns repeats."""
    return quality.unique(table(spark, sf_dir, "lineitem").select(surrogate_key(_SHORT_KEY).alias("short_key")), "short_key")


_NULLABLE = ["trip_key", "vendor_id", "trip_type", "airport_fee", "ehail_fee", "cbd_congestion_fee", "pickup_at"]


@query(
    f"WITH {TRIPS_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM trips" for c in _NULLABLE
    )
)
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_counts(plan.all_trips(*raw_feeds(spark, sf_dir)), _NULLABLE)


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag FROM lineitem WHERE l_returnflag NOT IN ('A', 'N')")
def dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    failing = quality.accepted_values(table(spark, sf_dir, "lineitem"), "l_returnflag", ["A", "N"])
    return failing.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")


_ORPHANS_SQL = f"""
    WITH {VENDORS_SQL}
    SELECT l_suppkey, count(*) AS row_count FROM lineitem
    WHERE l_suppkey NOT IN (SELECT vendor_id FROM vendors) GROUP BY l_suppkey"""


@query(_ORPHANS_SQL)
def dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.relationships(table(spark, sf_dir, "lineitem"), "l_suppkey", vendor_lookup(spark, sf_dir), "vendor_id")


@query(
    f"""
    SELECT 'vendor' AS relation, CAST(sum(row_count) AS BIGINT) AS failures,
           CASE WHEN sum(row_count) > 100 THEN 'error' WHEN sum(row_count) > 0 THEN 'warn' ELSE 'pass' END AS status
    FROM ({_ORPHANS_SQL})
    UNION ALL
    SELECT 'zone', count(*), CASE WHEN count(*) > 100 THEN 'error' WHEN count(*) > 0 THEN 'warn' ELSE 'pass' END
    FROM supplier WHERE s_nationkey NOT IN (SELECT n_nationkey FROM nation)
    """
)
def dq_relationship_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphaned vendors are too many; every zone has its parent."""
    zones = plan.zone_reference(raw_zones(spark, sf_dir))
    vendors = quality.relationship_status(dq_relationships(spark, sf_dir))
    locations = quality.relationship_status(
        quality.relationships(table(spark, sf_dir, "supplier"), "s_nationkey", zones, "location_id")
    )
    return vendors.withColumn("relation", F.lit("vendor")).unionByName(locations.withColumn("relation", F.lit("zone")))


@query(f"WITH {_OBSERVED_SQL} SELECT vendor_id, count(*) AS versions FROM history GROUP BY vendor_id HAVING count(*) > 1")
def dq_single_open_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history whose closing step never ran: renamed vendors have two open versions."""
    broken = vendor_history(spark, sf_dir).withColumn("is_current", F.lit(True))
    return quality.single_open_version(broken, "vendor_id")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE NOT (l_quantity <= 40 AND l_discount < 0.08)")
def dq_expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    failing = quality.expression_is_true(table(spark, sf_dir, "lineitem"), "l_quantity <= 40 AND l_discount < 0.08")
    return failing.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


_LOOKS = ("2024-02-15 00:00:00", "2024-04-20 00:00:00", "2024-08-01 00:00:00")


@query(
    " UNION ALL ".join(
        f"""SELECT TIMESTAMP '{look}' AS looked_at, max(ts) AS newest,
            CAST(floor(epoch(TIMESTAMP '{look}')) - floor(epoch(max(ts))) AS BIGINT) AS age_seconds,
            CASE WHEN epoch(TIMESTAMP '{look}') - floor(epoch(max(ts))) > 120 * 86400 THEN 'error'
                 WHEN epoch(TIMESTAMP '{look}') - floor(epoch(max(ts))) > 75 * 86400 THEN 'warn' ELSE 'pass' END AS status
            FROM events"""
        for look in _LOOKS
    )
)
def freshness_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table seen fresh, stale and too old."""
    events = table(spark, sf_dir, "events")
    seen = [
        quality.freshness(events, "ts", look).withColumn("looked_at", F.lit(look).cast("timestamp")) for look in _LOOKS
    ]
    return seen[0].unionByName(seen[1]).unionByName(seen[2])


@query(
    f"WITH {ENRICHED_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM fact"
        for c in plan.TRIP_CONTRACT.required
    )
)
def contract_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULLs in the columns the fact's contract requires."""
    return null_violations(enriched(spark, sf_dir), plan.TRIP_CONTRACT)


@query(
    """
    SELECT difference, (SELECT count(*) FROM lineitem) AS rows_refused
    FROM (VALUES ('missing vendor_name'), ('extra l_partkey'), ('l_linenumber is int, declared bigint')) v(difference)
    """
)
def contract_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table against a declaration with a column more, one less and one of another type."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    declared = {"l_orderkey": "bigint", "l_linenumber": "bigint", "vendor_name": "string"}
    found = schema_differences(lines.schema, declared)
    return small_frame(spark, [(d, lines.count()) for d in found], "difference string, rows_refused bigint")


@query(
    f"""
    WITH {VENDORS_SQL}, counts AS (
      SELECT 'order_key_present' AS test, count(*) FILTER (WHERE l_orderkey IS NULL) AS failures, 0 AS warn_if, 0 AS error_if FROM lineitem
      UNION ALL SELECT 'known_flags', count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N')), 0, 1000000000000 FROM lineitem
      UNION ALL SELECT 'known_vendors', count(*) FILTER (WHERE l_suppkey NOT IN (SELECT vendor_id FROM vendors)), 0, 100 FROM lineitem
    )
    SELECT test, failures, CASE WHEN failures > error_if THEN 'error' WHEN failures > warn_if THEN 'warn' ELSE 'pass' END AS status
    FROM counts
    """
)
def data_test_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three tests in one run, each leaving its failing rows in a table."""
    lines = table(spark, sf_dir, "lineitem")
    folder = workspace(spark, "failures")
    database = create_database(spark, f"failures_{folder[-12:]}", folder)
    tests = [
        quality.not_null_test("order_key_present", lines, "l_orderkey"),
        quality.accepted_values_test("known_flags", lines, "l_returnflag", ["A", "N"], error_if=1_000_000_000_000),
        quality.relationships_test("known_vendors", lines, "l_suppkey", vendor_lookup(spark, sf_dir), "vendor_id"),
    ]
    return quality.run_tests(spark, tests, failures_in=database)


@query(
    f"""
    WITH {VENDORS_SQL}, failing AS (
      SELECT 'known_flags' AS test, l_orderkey AS key, 1 AS weight FROM lineitem WHERE l_returnflag NOT IN ('A', 'N')
      UNION ALL SELECT 'known_vendors', l_suppkey, count(*) FROM lineitem
      WHERE l_suppkey NOT IN (SELECT vendor_id FROM vendors) GROUP BY l_suppkey
      UNION ALL SELECT 'quantity_small', l_orderkey, 1 FROM lineitem WHERE l_quantity > 45
      UNION ALL SELECT 'order_once', l_orderkey, 1 FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1
    ), sums AS (
      SELECT test, CAST(sum(weight) AS BIGINT) AS failures, count(*) AS stored_rows, CAST(sum(key) AS BIGINT) AS key_sum FROM failing GROUP BY test
    )
    SELECT test, coalesce(failures, 0) AS failures, coalesce(stored_rows, 0) AS stored_rows, coalesce(key_sum, 0) AS key_sum,
           CASE WHEN coalesce(failures, 0) > error_if THEN 'error' WHEN coalesce(failures, 0) > warn_if THEN 'warn' ELSE 'pass' END AS status
    FROM (VALUES ('known_flags', 0, 1000000000000), ('known_vendors', 0, 100), ('quantity_small', 0, 0), ('order_once', NULL, 0),
      ('order_key_present', NULL, 0)) v(test, warn_if, error_if) LEFT JOIN sums USING (test)
    """
)
def stored_test_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five tests in one writing job; what is counted is what is stored, and it is read back from there."""
    lines = table(spark, sf_dir, "lineitem")
    folder = workspace(spark, "failures")
    stored = create_database(spark, f"failures_{folder[-12:]}", folder) + ".failing"
    tests = [
        quality.accepted_values_test("known_flags", lines, "l_returnflag", ["A", "N"], error_if=1_000_000_000_000),
        quality.relationships_test("known_vendors", lines, "l_suppkey", vendor_lookup(spark, sf_dir), "vendor_id"),
        quality.DataTest("quantity_small", lines, F.col("l_quantity") > 45, warn_if=0),
        quality.unique_test("order_once", lines, "l_orderkey"),
        quality.not_null_test("order_key_present", lines, "l_orderkey"),
    ]
    report = quality.run_and_store(spark, stored, tests)
    key = F.coalesce(F.get_json_object("failing", "$.l_orderkey"), F.get_json_object("failing", "$.l_suppkey")).cast("bigint")
    held = spark.table(stored).groupBy("test").agg(F.count(F.lit(1)).alias("stored_rows"), F.sum(key).alias("key_sum"))
    return report.join(held, "test", "left").fillna(0, ["stored_rows", "key_sum"])
