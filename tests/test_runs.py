"""Landed taxi files to published tables, end to end."""

import os
from datetime import datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import rows

from tideline.operators.quality import run_tests
from tideline.plans import checks
from tideline.plans import trips as plan
from tideline.plans import runs
from tideline.plans.runs import load_feed, refresh_reference, refresh_trip_fact, refresh_vendor_dimension

T1, T2 = datetime(2025, 4, 1), datetime(2025, 5, 1)


def trip(prefix, vendor, pickup, total=10.0, **extra):
    base = {
        "VendorID": vendor, f"{prefix}_pickup_datetime": pickup, f"{prefix}_dropoff_datetime": pickup.replace(minute=45),
        "passenger_count": 1, "trip_distance": 2.5, "RatecodeID": 1, "store_and_fwd_flag": "N", "PULocationID": 4,
        "DOLocationID": 264, "payment_type": 2, "fare_amount": 8.0, "extra": 0.5, "mta_tax": 0.5, "tip_amount": 0.0,
        "tolls_amount": 0.0, "improvement_surcharge": 1.0, "total_amount": total, "congestion_surcharge": 0.0,
    }
    return {**base, **extra}


def land(folder, dataset, period, trips):
    path = folder / f"dataset={dataset}" / f"period={period}"
    path.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.Table.from_pylist(trips), path / f"{dataset}_tripdata_{period}.parquet")


@pytest.fixture
def lake(spark, db, tmp_path):
    class Lake:
        landing = tmp_path / "landing"
        yellow, green, fact = f"{db}.yellow", f"{db}.green", f"{db}.trips"
        history, dimension = f"{db}.vendor_history", f"{db}.vendor"

        def load(self):
            return [
                load_feed(spark, table, f"{self.landing}/dataset={name}", name, actor="me")
                for name, table in (("yellow", self.yellow), ("green", self.green))
            ]

        def refresh(self, at, vendors=plan.VENDORS, **options):
            names = plan.code_list(spark, vendors, "vendor_id", "vendor_name")
            raw = spark.table(self.yellow), spark.table(self.green)
            refresh_vendor_dimension(spark, self.history, self.dimension, plan.all_trips(*raw), names, at)
            codes = (
                plan.code_list(spark, plan.RATE_CODES, "rate_code_id", "rate_code_description"),
                plan.code_list(spark, plan.PAYMENT_TYPES, "payment_type", "payment_type_description"),
                plan.code_list(spark, plan.TRIP_TYPES, "trip_type", "trip_type_description"),
            )
            return refresh_trip_fact(spark, self.fact, *raw, self.dimension, codes, at, "me", **options)

    lake = Lake()
    land(lake.landing, "yellow", "2025-01", [trip("tpep", 1, datetime(2025, 1, 15, 12), Airport_fee=1.75), trip("tpep", 9, datetime(2025, 1, 16, 23), Airport_fee=0.0)])
    land(lake.landing, "green", "2025-01", [trip("lpep", 1, datetime(2025, 1, 15, 12), ehail_fee=0.5, trip_type=1)])
    lake.load()
    lake.refresh(T1)
    return lake


def test_first_build(spark, lake):
    fact = spark.table(lake.fact)
    assert sorted(fact.columns) == sorted(plan.TRIP_CONTRACT.types)
    got = fact.select(
        "tlc_type", "vendor_name", "trip_type_description", "pickup_at", "pickup_hour", "pickup_day_of_week",
        "trip_duration_minutes", "airport_fee", "ehail_fee", "cbd_congestion_fee", "source_period",
    )
    assert rows(got) == [
        ("Green Taxi", plan.VENDORS[1], "Street-hail", datetime(2025, 1, 15, 17), 12, 4, 45.0, None, 0.5, 0.0, "2025-01"),
        ("Yellow Taxi", plan.VENDORS[1], None, datetime(2025, 1, 15, 17), 12, 4, 45.0, 1.75, None, 0.0, "2025-01"),
        ("Yellow Taxi", "Unknown vendor (9)", None, datetime(2025, 1, 17, 4), 23, 5, 45.0, 0.0, None, 0.0, "2025-01"),
    ]
    assert len({r.trip_key for r in fact.collect()}) == 3


def test_next_month_with_a_new_column_and_a_renamed_vendor(spark, lake):
    land(lake.landing, "yellow", "2025-02", [trip("tpep", 9, datetime(2025, 2, 1, 8), Airport_fee=0.0, cbd_congestion_fee=0.75)])
    reports = lake.load()
    assert [r.summary.files_loaded for r in reports] == [1, 0]
    assert "cbd_congestion_fee" in reports[0].drift[0] and not reports[1].drift
    assert reports[0].newest == [("2025-02", 1), ("2025-01", 2)]
    result = lake.refresh(T2, {**plan.VENDORS, 9: "Newcomer"})
    assert (result.mode, result.rows_written) == ("incremental", 4)
    fact = spark.table(lake.fact)
    assert rows(fact.where("vendor_id = 9").select("source_period", "vendor_name", "cbd_congestion_fee")) == [
        ("2025-01", "Newcomer", 0.0), ("2025-02", "Newcomer", 0.75),
    ]
    dimension = spark.table(lake.dimension).where("vendor_id = 9")
    assert rows(dimension.select("vendor_name", "is_unmapped", "valid_from", "is_current")) == [
        ("Newcomer", False, T2, True), ("Unknown vendor (9)", True, T1, False),
    ]


def test_rerun_changes_only_the_audit_time(spark, lake):
    before = rows(spark.table(lake.fact).drop("updated_at"))
    lake.load()
    lake.refresh(T2)
    assert rows(spark.table(lake.fact).drop("updated_at")) == before
    assert spark.table(lake.fact).select("updated_at").distinct().collect() == [(T2,)]


def test_restated_older_month_by_name(spark, lake):
    land(lake.landing, "yellow", "2025-02", [trip("tpep", 1, datetime(2025, 2, 1, 8), Airport_fee=0.0)])
    lake.load()
    lake.refresh(T1)
    january = lake.landing / "dataset=yellow" / "period=2025-01" / "yellow_tripdata_2025-01.parquet"
    land(lake.landing, "yellow", "2025-01", [trip("tpep", 1, datetime(2025, 1, 15, 12), Airport_fee=5.0)])
    os.utime(january, (2_000_000_000, 2_000_000_000))
    lake.load()
    lake.refresh(T2, latest_by=["loaded_at"])
    changed = spark.table(lake.fact).where("airport_fee = 5.0")
    assert changed.count() == 0  # older than the mark
    lake.refresh(T2, periods=["2025-01"], latest_by=["loaded_at"])
    assert changed.count() == 1
    assert spark.table(lake.fact).count() == 4


def test_all_published_checks(spark, lake):
    zones = spark.createDataFrame([(4,), (264,)], "location_id long")
    seeds = {
        name: (plan.code_list(spark, values, key, "name"), key)
        for name, values, key in [
            ("vendor", plan.VENDORS, "vendor_id"), ("rate", plan.RATE_CODES, "rate_code_id"),
            ("payment", plan.PAYMENT_TYPES, "payment_type"), ("trip", plan.TRIP_TYPES, "trip_type"),
        ]
    }
    tests = [
        *checks.lookup_tests(seeds),
        *checks.feed_tests(plan.yellow_trips(spark.table(lake.yellow)), plan.green_trips(spark.table(lake.green))),
        *checks.key_tests("zone", zones, "location_id"),
        *checks.dimension_tests(spark.table(lake.dimension)),
        *checks.fact_tests(spark.table(lake.fact), zones),
    ]
    assert len(tests) == 28
    assert {r.status for r in run_tests(spark, tests).collect()} == {"pass"}


def test_files_fit_a_raw_table_made_before(spark, db, tmp_path):
    raw = f"{db}.yellow"
    plan.create_raw_table(spark, raw, "tpep")
    land(tmp_path, "yellow", "2025-01", [trip("tpep", 1, datetime(2025, 1, 15, 12), Airport_fee=1.75, cbd_congestion_fee=0.5)])
    load_feed(spark, raw, f"{tmp_path}/dataset=yellow", "yellow")
    stored = dict(spark.table(raw).dtypes)
    assert (stored["vendorid"], stored["ratecodeid"], stored["cbd_congestion_fee"]) == ("int", "bigint", "double")
    conformed = plan.yellow_trips(spark.table(raw))
    assert rows(conformed.select("vendor_id", "airport_fee", "cbd_congestion_fee")) == [(1, 1.75, 0.5)]
    assert len(conformed.columns) == 29
    comments = {c.name: c.description for c in spark.catalog.listColumns(raw)}
    assert comments["trip_distance"] == "miles"


def test_reference_csv(spark, db, tmp_path):
    def write(borough):
        lines = ["LocationID,Borough,Zone,service_zone", *[f"{i},{borough},Zone {i},Boro" for i in range(1, 266)]]
        path = tmp_path / "zones.csv"
        path.write_text("\n".join(lines), encoding="utf-8-sig")
        return str(path)

    table, state, landing = f"{db}.zones", f"{db}.zone_state", str(tmp_path / "reference")

    def run(day):
        return refresh_reference(spark, table, str(tmp_path / "zones.csv"), landing, state, at=datetime(2025, 1, day))

    write("Bronx")
    assert run(1) == "landed"
    assert run(2) == "unchanged"
    write("Queens")
    assert run(3) == "landed"
    zones = plan.zone_reference(spark.table(table))
    assert zones.count() == 265
    assert rows(zones.where("is_unknown_zone").select("location_id", "borough")) == [(264, "Queens"), (265, "Queens")]
    spark.sql(f"DROP TABLE {table}")  # as after a table load that failed
    assert run(4) == "reloaded"
    assert spark.table(table).count() == 265


def test_vendors_are_observed_in_new_loads_only(spark, lake, db):
    names = plan.code_list(spark, plan.VENDORS, "vendor_id", "vendor_name")
    observed, raw = f"{db}.observed", (lake.yellow, lake.green)

    def refresh(at):
        return runs.refresh_vendors_of_loads(spark, f"{db}.h", f"{db}.d", observed, *raw, names, at)

    assert refresh(T1) == 2
    land(lake.landing, "yellow", "2025-02", [trip("tpep", 8, datetime(2025, 2, 1, 12), Airport_fee=0.0), trip("tpep", 1, datetime(2025, 2, 2, 12), Airport_fee=0.0)])
    lake.load()
    earlier = spark.table(observed).count()
    assert refresh(T2) == 1
    assert spark.table(observed).count() == earlier + 3  # two vendors and the note
    assert rows(spark.table(f"{db}.d").select("vendor_id")) == [(1,), (8,), (9,)]
    assert refresh(T2) == 0
    whole = plan.observed_vendors(plan.all_trips(*map(spark.table, raw)), names).groupBy("vendor_id").sum("trip_count")
    summed = spark.table(observed).where("vendor_id IS NOT NULL").groupBy("vendor_id").sum("trip_count")
    assert rows(whole) == rows(summed)


def test_stale_raw_tables_fail_the_run(spark, lake):
    now = datetime.now()
    assert runs.check_raw_freshness(spark, [lake.yellow, lake.green], now) == {lake.yellow: "pass", lake.green: "pass"}
    with pytest.raises(ValueError, match="not loaded"):
        runs.check_raw_freshness(spark, [lake.green], datetime(now.year + 1, 1, 1), error_days=0)
