"""Physical plans: what must be pushed down, broadcast, or left without a shuffle."""

import pytest

from tideline.operators.lookup import left_lookup
from tideline.plans import trips as plan
from tideline.queries import enrich, feeds

SF = "/root/testdata/sf0.001"


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stored_feeds(spark, tmp_path):
    for status in "FO":
        feeds.raw_feed(spark, SF, status).write.parquet(f"{tmp_path}/{status}")
    return [spark.read.parquet(f"{tmp_path}/{status}") for status in "FO"]


def test_fact_is_built_without_a_shuffle(spark, stored_feeds):
    fact = plan.trip_fact(
        plan.all_trips(*stored_feeds), enrich.vendor_dimension(spark, SF), *feeds.code_lists(spark), enrich.AS_OF, "me"
    )
    text = physical(fact)
    assert "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text
    assert text.count("BroadcastHashJoin") >= 4


def test_only_needed_columns_are_read(spark, stored_feeds):
    trips = plan.all_trips(*stored_feeds)
    text = physical(plan.observed_vendors(trips, feeds.vendor_lookup(spark, SF)))
    assert "fare_amount" not in text and "trip_distance" not in text


def test_filter_reaches_the_scan(spark, stored_feeds):
    trips = plan.all_trips(*stored_feeds).where("source_period >= '2001-01'")
    assert physical(trips).count("GreaterThanOrEqual(period,2001-01)") == 2


def test_a_large_lookup_is_not_broadcast(spark, stored_feeds):
    big = spark.range(0, 50_000_000).selectExpr("id AS code", "CAST(id AS STRING) AS name")
    text = physical(left_lookup(stored_feeds[0], big, "vendorid", "code", {"name": "name"}))
    assert "SortMergeJoin" in text


def test_a_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    from tideline.operators.versions import stage

    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "64KB")
    try:
        df = spark.range(200_000, numPartitions=8).selectExpr("id", "IF(id % 3 = 0, CAST(id % 50 AS STRING), 'hot') AS period")
        staged = stage(df, str(tmp_path / "rows"), ["period"])
    finally:
        spark.conf.set(key, before)
    assert staged.rows == 200_000
    assert len(list((tmp_path / "rows" / "period=hot").glob("*.parquet"))) > 1


def test_merge_reads_only_key_and_partition_to_find_its_partitions(spark, stored_feeds):
    target, fresh = stored_feeds[0], stored_feeds[0].select("vendorid")
    text = physical(target.select("vendorid", "period").join(fresh, "vendorid", "left_semi").select("period").distinct())
    assert "fare_amount" not in text
