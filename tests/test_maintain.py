from datetime import datetime, timedelta, timezone

from conftest import rows
from pyspark.sql import functions as F

from tideline.operators.governance import apply_governance, describe_governance, tag_database
from tideline.operators.maintain import clustered, compact, describe_detail, expire_versions
from tideline.operators.manifest import from_json_lines, to_json_lines, update_manifest
from tideline.operators.versions import replace_contents


def test_compaction_keeps_rows_and_reduces_files(spark, db):
    table = f"{db}.t"
    df = spark.range(1000).withColumn("period", (F.col("id") % 3).cast("string"))
    spark.sql(f"CREATE TABLE {table} (id BIGINT, period STRING) USING parquet PARTITIONED BY (period)")
    df.repartition(5).write.insertInto(table)
    before = rows(spark.table(table))
    assert describe_detail(spark.table(table)).first().num_files == 15
    assert compact(spark, table, "id") == 3
    assert rows(spark.table(table)) == before
    assert describe_detail(spark.table(table)).first().num_files == 3
    assert compact(spark, table, "id") == 0


def test_a_large_partition_is_cut_and_left_alone_by_the_next_run(spark, db):
    table = f"{db}.t"
    df = spark.range(60_000).select(F.rand(1).alias("x"), F.when(F.col("id") % 3 > 0, "hot").otherwise((F.col("id") % 7).cast("string")).alias("period"))
    spark.sql(f"CREATE TABLE {table} (x DOUBLE, period STRING) USING parquet PARTITIONED BY (period)")
    df.repartition(16).write.insertInto(table)
    before = rows(spark.table(table))
    assert compact(spark, table, "x", target_bytes=100_000) == 8
    files = {r.period: r.num_files for r in describe_detail(spark.table(table), ["period"]).collect()}
    assert 2 <= files.pop("hot") <= 6 and set(files.values()) == {1}
    assert rows(spark.table(table)) == before
    assert compact(spark, table, "x", target_bytes=100_000) == 0


def test_files_are_listed_without_reading_rows(spark, db):
    table = f"{db}.t"
    replace_contents(spark, table, spark.range(90).withColumn("p", F.col("id") % 3), ["p"])
    detail = describe_detail(spark.table(table), ["p"])
    plan = detail._jdf.queryExecution().executedPlan().toString()
    assert "binaryFile" in plan and "parquet" not in plan.lower().replace(".parquet", "")
    assert [(r.p, r.num_files) for r in detail.orderBy("p").collect()] == [(0, 1), (1, 1), (2, 1)]
    assert rows(describe_detail(spark.table(table).where("p = 1"), ["p"]).select("p")) == [(1,)]


def test_a_table_without_rows_keeps_its_version(spark, db):
    table = f"{db}.t"
    replace_contents(spark, table, spark.range(3))
    replace_contents(spark, table, spark.range(0))
    now = datetime.now(timezone.utc)
    expire_versions(spark, table, now=now)
    assert len(expire_versions(spark, table, now=now + timedelta(days=8))) == 1
    assert spark.table(table).count() == 0


def test_a_hot_value_is_spread_over_tasks(spark):
    df = spark.range(4000).select("id", F.when(F.col("id") % 10 < 9, "hot").otherwise("cold").alias("period"))
    parts = clustered(df, "period", 8).where("period = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) >= 6


def test_version_goes_only_after_a_week_unused(spark, db):
    table = f"{db}.t"
    replace_contents(spark, table, spark.range(3))
    replace_contents(spark, table, spark.range(5))
    now = datetime.now(timezone.utc)
    assert expire_versions(spark, table, now=now) == []
    assert expire_versions(spark, table, now=now + timedelta(days=6)) == []
    assert len(expire_versions(spark, table, now=now + timedelta(days=7))) == 1
    assert spark.table(table).count() == 5
    assert expire_versions(spark, table, now=now + timedelta(days=30)) == []


def test_governance(spark, db):
    table = f"{db}.t"
    replace_contents(spark, table, spark.range(3))
    tag_database(spark, db, {"layer": "raw"}, "Landed 'as is'")
    apply_governance(spark, table, {"dataOwner": "me"}, "it's a table", {"id": "the key"})
    assert rows(describe_governance(spark, table)) == [("column", "id", "the key"), ("tag", "dataOwner", "me")]
    described = {r[0]: r[1] for r in spark.sql(f"DESCRIBE DATABASE EXTENDED {db}").collect()}
    assert described["Comment"] == "Landed 'as is'" and "layer,raw" in described["Properties"].replace(" ", "").strip("()")


def test_manifest_upsert_and_exchange(spark):
    schema = "key string, etag string, columns array<string>"
    manifest = spark.createDataFrame([("a", "1", ["x"]), ("b", "1", ["x"])], schema)
    updated = update_manifest(manifest, spark.createDataFrame([("b", "2", ["x", "y"]), ("c", "1", [])], schema))
    expected = [("a", "1", ["x"]), ("b", "2", ["x", "y"]), ("c", "1", [])]
    assert rows(updated, "key") == expected
    assert rows(from_json_lines(to_json_lines(updated), schema), "key") == expected
