"""The runs from landed files to published tables, over the given tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators.ingest import committed, latest_files
from tideline.operators.quality import run_tests
from tideline.operators.scd2 import open_versions, present_dimension
from tideline.operators.versions import create_database
from tideline.plans import checks
from tideline.plans import trips as plan
from tideline.plans.runs import check_raw_freshness, load_feed, refresh_trip_fact, refresh_vendors_of_loads, reload_seeds
from tideline.queries.conform import raw_zones
from tideline.queries.enrich import ACTOR, AS_OF, ENRICHED_SQL, enriched, vendor_dimension
from tideline.queries.feeds import CODES_SQL, TRIPS_SQL, VENDORS_SQL, code_lists, raw_feeds, vendor_lookup
from tideline.queries.landing import land
from tideline.queries.registry import query
from tideline.session import workspace
from tideline.sources.files import list_files

# Not in the comparison: where, when and by whom a row was loaded differs from run to run.
_STABLE = [c for c in plan.TRIP_CONTRACT.types if c not in ("source_file", "loaded_at", "updated_at", "updated_by")]


@query(f"WITH {ENRICHED_SQL} SELECT {', '.join(_STABLE)} FROM fact")
def landed_to_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both feeds landed, loaded, conformed, enriched and merged: old months first, then new ones."""
    folder = workspace(spark, "landed")
    database = create_database(spark, f"landed_{folder[-12:]}", f"{folder}/db")
    names = {"yellow": f"{database}.yellow_trips", "green": f"{database}.green_trips"}
    feeds = dict(zip(names, raw_feeds(spark, sf_dir), strict=True))
    for day, months in ((1, "period < '2001-06'"), (2, "period >= '2001-06'")):
        at = datetime(2002, 1, day)
        for name, raw in feeds.items():
            source = f"{folder}/landing/dataset={name}"
            land(raw.drop("_loaded_from", "_loaded_at").where(months), source, "period")
            load_feed(spark, names[name], source, name, loaded_at=at, actor="loader")
        raw_tables = [committed(spark, t) for t in names.values()]
        check_raw_freshness(spark, list(names.values()), at)
        history, dimension = f"{database}.vendor_history", f"{database}.vendor"
        refresh_vendors_of_loads(
            spark, history, dimension, f"{database}.vendors_observed", *names.values(), vendor_lookup(spark, sf_dir), at
        )
        refresh_trip_fact(spark, f"{database}.trips", *raw_tables, dimension, code_lists(spark), at, "loader")
    return spark.table(f"{database}.trips").select(*_STABLE)


_RESTATED = "2001-05"
_RESTATED_LINES = f"""
restated AS (
  SELECT * REPLACE (CASE WHEN l_linestatus = 'F' AND strftime(l_shipdate, '%Y-%m') = '{_RESTATED}' AND l_linenumber = 2
                         THEN l_quantity + 1 ELSE l_quantity END AS l_quantity)
  FROM lineitem WHERE NOT (l_linestatus = 'F' AND strftime(l_shipdate, '%Y-%m') = '{_RESTATED}' AND l_linenumber = 1)
)"""


@query(
    f"WITH {_RESTATED_LINES}, {ENRICHED_SQL.replace('lineitem', 'restated')} "
    f"SELECT {', '.join(_STABLE)} FROM fact WHERE source_period >= '2001'"
)
def restated_to_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month is published again: some trips are gone from it, others have other keys.  The green feed lags, and
    what it delivers late arrives with the restated month."""
    folder = workspace(spark, "restated")
    database = create_database(spark, f"restated_{folder[-12:]}", f"{folder}/db")
    names = {"yellow": f"{database}.yellow_trips", "green": f"{database}.green_trips"}
    feeds = {n: raw.drop("_loaded_from", "_loaded_at").where("period >= '2001'") for n, raw in zip(names, raw_feeds(spark, sf_dir), strict=True)}
    fact, history, dimension = f"{database}.trips", f"{database}.vendor_history", f"{database}.vendor"

    def run(day: int, **options) -> None:
        at = datetime(2002, 1, day)
        for name, raw in names.items():
            load_feed(spark, raw, f"{folder}/landing/dataset={name}", name, loaded_at=at, actor="loader")
        refresh_vendors_of_loads(spark, history, dimension, f"{database}.vendors_observed", *names.values(), vendor_lookup(spark, sf_dir), at)
        current = [latest_files(spark, raw, list_files(spark, f"{folder}/landing/dataset={n}", "*.parquet")) for n, raw in names.items()]
        refresh_trip_fact(spark, fact, *current, dimension, code_lists(spark), at, "loader", snapshot=True, **options)

    land(feeds["yellow"], f"{folder}/landing/dataset=yellow", "period")
    land(feeds["green"].where("period <= '2001-03'"), f"{folder}/landing/dataset=green", "period")
    run(1)
    month = feeds["yellow"].where(F.col("period") == _RESTATED).where("ratecodeid <> 1")
    more = F.when(F.col("ratecodeid") == 2, 1).otherwise(0)
    month = month.withColumns({"passenger_count": F.col("passenger_count") + more, "trip_distance": F.col("trip_distance") + more})
    land(month, f"{folder}/landing/dataset=yellow", "period", mode="overwrite")
    land(feeds["green"].where("period > '2001-03'"), f"{folder}/landing/dataset=green", "period")
    run(2)  # what is new, each feed from its own mark
    run(3, periods=[_RESTATED])
    return spark.table(fact).select(*_STABLE)


_COUNTS = {
    "vendor_vendor_id_unique": "SELECT 0",
    "vendor_vendor_id_not_null": "SELECT 0",
    "yellow_pickup_at_not_null": "SELECT count(*) FROM fact WHERE tlc_type = 'Yellow Taxi' AND pickup_at IS NULL",
    "yellow_tlc_type_accepted": "SELECT 0",
    "green_pickup_at_not_null": "SELECT count(*) FROM fact WHERE tlc_type = 'Green Taxi' AND pickup_at IS NULL",
    "green_tlc_type_accepted": "SELECT 0",
    "zone_location_id_unique": "SELECT count(*) FROM (SELECT 1 FROM nation GROUP BY n_nationkey HAVING count(*) > 1)",
    "zone_location_id_not_null": "SELECT count(*) FROM nation WHERE n_nationkey IS NULL",
    "vendor_vendor_key_unique": "SELECT 0",
    "vendor_vendor_key_not_null": "SELECT 0",
    "vendor_id_not_null": "SELECT count(*) FROM vendors WHERE vendor_id IS NULL",
    "vendor_name_not_null": "SELECT count(*) FROM vendors WHERE vendor_name IS NULL",
    "vendor_single_open_version": "SELECT count(*) FROM (SELECT 1 FROM vendors GROUP BY vendor_id HAVING count(*) > 1)",
    "fact_trip_key_unique": "SELECT count(*) FROM (SELECT 1 FROM fact GROUP BY trip_key HAVING count(*) > 1)",
    **{
        f"fact_{c}_not_null": f"SELECT count(*) FROM fact WHERE {c} IS NULL"
        for c in (
            "trip_key", "tlc_type", "vendor_name", "rate_code_description", "payment_type_description", "pickup_at",
        )
    },
    "fact_tlc_type_accepted": "SELECT count(*) FROM fact WHERE tlc_type NOT IN ('Yellow Taxi', 'Green Taxi')",
    "fact_pickup_zone_known": "SELECT count(*) FROM fact WHERE pickup_location_id NOT IN (SELECT n_nationkey FROM nation)",
}


@query(
    f"WITH {ENRICHED_SQL}, counts AS ("
    + " UNION ALL ".join(f"SELECT '{name}' AS test, CAST(({sql}) AS BIGINT) AS failures" for name, sql in _COUNTS.items())
    + ") SELECT test, failures, CASE WHEN failures > 0 THEN 'error' ELSE 'pass' END AS status FROM counts"
)
def published_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tests of feeds, lookup, zones, dimension and fact in one run."""
    zones = plan.zone_reference(raw_zones(spark, sf_dir))
    yellow, green = raw_feeds(spark, sf_dir)
    fact = workspace(spark, "checked_fact")
    enriched(spark, sf_dir).write.parquet(fact)  # several tests read it, so it is computed once
    tests = [
        *checks.lookup_tests({"vendor": (vendor_lookup(spark, sf_dir), "vendor_id")}),
        *checks.feed_tests(plan.yellow_trips(yellow), plan.green_trips(green)),
        *checks.key_tests("zone", zones, "location_id"),
        *checks.dimension_tests(vendor_dimension(spark, sf_dir)),
        *checks.fact_tests(spark.read.parquet(fact), zones),
    ]
    return run_tests(spark, tests)


@query(
    f"""
    WITH {TRIPS_SQL}, {VENDORS_SQL}, {CODES_SQL}
    SELECT coalesce(upper(v.vendor_name), 'Unknown vendor (' || t.vendor_id || ')') AS vendor_name,
           coalesce(p.payment_type_description, 'Unknown payment type (' || t.payment_type || ')') AS payment_type_description,
           count(*) AS trips
    FROM trips t
    LEFT JOIN vendors v ON t.vendor_id = v.vendor_id AND v.vendor_id % 7 <> 0
    LEFT JOIN payment_types p ON t.payment_type = p.payment_type AND p.payment_type <> 2
    GROUP BY ALL
    """
)
def seeds_to_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code lists as CSV files: loaded; loaded again with other names and fewer codes; then with a key that occurs
    twice, which is refused and changes nothing.  The fact is named by what is stored."""
    folder = workspace(spark, "seeds")
    database = create_database(spark, f"seeds_{folder[-12:]}", f"{folder}/db")
    vendors, (rates, payments, types) = vendor_lookup(spark, sf_dir), code_lists(spark)
    renamed = vendors.where("vendor_id % 7 <> 0").withColumn("vendor_name", F.upper("vendor_name"))
    fewer = payments.where("payment_type <> 2")
    stored = {}
    for day, lists in enumerate([(vendors, rates, payments, types), (renamed, rates, fewer, types), (vendors, rates, payments, types.union(types))], 1):
        for name, rows in zip(plan.SEEDS, lists, strict=True):
            rows.coalesce(1).write.option("header", True).csv(f"{folder}/{day}/{name}.csv")
        try:
            stored = reload_seeds(spark, database, f"{folder}/{day}", at=datetime(2002, 1, day))
        except ValueError as refusal:
            if day < 3 or "trip_type_lookup_trip_type_unique" not in str(refusal):
                raise
        else:
            if day == 3:
                raise AssertionError("a key that occurs twice was not refused")
    named, *lists = stored.values()
    opened = open_versions(named.withColumn("is_unmapped", F.lit(False)), "vendor_id", datetime(1995, 1, 1))
    dimension = present_dimension(opened, "vendor_id", "vendor_key")
    fact = plan.trip_fact(plan.all_trips(*raw_feeds(spark, sf_dir, locations=False)), dimension, *lists, AS_OF, ACTOR)
    return fact.groupBy("vendor_name", "payment_type_description").agg(F.count("*").alias("trips"))
