import random
from datetime import datetime, timedelta

from conftest import rows
from pyspark.sql import functions as F

from tideline.operators.lookup import as_of_join, lookup_with_fallback, point_in_time_join


def facts(spark):
    return spark.sql("SELECT * FROM VALUES (1, 1L), (2, 9L), (3, CAST(NULL AS BIGINT)), (4, 1L) AS t(id, code)")


def names(spark):
    return spark.sql("SELECT * FROM VALUES (1L, 'one'), (2L, 'two') AS t(code, name)")


def label(spark, **options):
    return lookup_with_fallback(facts(spark), names(spark), "code", "code", "name", "label", "vendor", "missing", **options)


def test_known_unknown_and_null_codes(spark):
    expected = [(1, 1, "one", False), (2, 9, "Unknown vendor (9)", True), (3, None, None, True), (4, 1, "one", False)]
    assert rows(label(spark)) == expected
    assert rows(label(spark, salt_by="id")) == expected


def test_point_in_time_meets_one_version(spark):
    dimension = spark.sql(
        "SELECT * FROM VALUES (1L, 'old', timestamp'2020-01-01', timestamp'2021-01-01'), "
        "(1L, 'new', timestamp'2021-01-01', timestamp'9999-12-31') AS t(key, name, valid_from, valid_to)"
    )
    fact = spark.sql(
        "SELECT * FROM VALUES (1, 1L, timestamp'2019-06-01'), (2, 1L, timestamp'2020-01-01'), "
        "(3, 1L, timestamp'2021-01-01'), (4, 2L, timestamp'2021-01-01') AS t(id, key, at)"
    )
    joined = point_in_time_join(fact, dimension, "key", "key", "at", {"name": "name"})
    assert rows(joined.select("id", "name")) == [(1, None), (2, "old"), (3, "new"), (4, None)]
    assert joined.columns == ["id", "key", "at", "name"]
    assert datetime(2019, 6, 1) in [r.at for r in joined.collect()]


def test_as_of_join_is_the_point_in_time_join_for_many_versions_and_hot_keys(spark):
    r = random.Random(5)
    cuts = sorted(r.sample(range(1, 5000), 1000))
    versions = [(1, f"v{i}", a, b) for i, (a, b) in enumerate(zip(cuts, [*cuts[1:], 9999]))]
    versions += [(2, "early", 10, 20), (2, "late", 40, 50), (3, "only", 0, 9999)]
    at = lambda n: datetime(2020, 1, 1) + timedelta(hours=n)
    dimension = spark.createDataFrame([(k, n, at(a), at(b)) for k, n, a, b in versions], "key long, name string, valid_from timestamp, valid_to timestamp")
    facts = [(i, r.choice([1, 1, 1, 1, 2, 3, 4, None]), at(r.randrange(0, 6000))) for i in range(3000)]
    facts += [(5000 + i, 1, at(cuts[i])) for i in range(50)] + [(6000 + i, 1, at(777)) for i in range(500)] + [(7000, 1, None), (7001, None, None), (7002, 1, at(9998))]
    facts += [(8000, 2, at(15))] * 5
    fact = spark.createDataFrame(facts, "`a.id` long, key long, at timestamp").repartition(3)
    values = {"name": "name", "valid_from": "since"}
    want = rows(point_in_time_join(fact, dimension, "key", "key", "at", values))
    for size in (1_000_000, 100):
        joined = as_of_join(fact, dimension, "key", "key", "at", values, rows_per_group=size)
        assert rows(joined) == want and joined.columns == ["a.id", "key", "at", "name", "since"]
    assert as_of_join(fact.limit(0), dimension, "key", "key", "at", values).count() == 0
    assert {r_[3] for r_ in rows(as_of_join(fact, dimension.limit(0), "key", "key", "at", values))} == {None}


def test_as_of_join_never_joins_facts_with_versions(spark):
    fact = spark.range(100).select(F.lit(1).alias("key"), F.current_timestamp().alias("at"))
    dimension = spark.range(5).select(F.lit(1).alias("key"), F.col("id").alias("name"), F.current_timestamp().alias("valid_from"), F.current_timestamp().alias("valid_to"))
    plan = as_of_join(fact, dimension, "key", "key", "at", {"name": "name"})._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan and "valid_from" not in "".join(x for x in plan.split("\n") if "Join" in x)
