from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tideline.operators import quality
from tideline.operators.contract import Contract, ContractColumn, SchemaMismatch, build_table, enforce_contract, null_violations

CONTRACT = Contract((ContractColumn("k", "string", True), ContractColumn("v", "bigint")))


def frame(spark, *data):
    return spark.createDataFrame(data, "k string, v long")


@pytest.mark.parametrize(("orphans", "status"), [(0, "pass"), (1, "warn"), (100, "warn"), (101, "error")])
def test_relationship_thresholds(spark, orphans, status):
    child = frame(spark, ("a", 1), ("null", None), *[("x", 2)] * orphans)
    failing = quality.relationships(child, "v", frame(spark, ("p", 1)), "v")
    assert quality.relationship_status(failing).first().status == status
    test = quality.relationships_test("zones", child, "v", frame(spark, ("p", 1)), "v")
    assert rows(quality.run_tests(spark, [test])) == [("zones", orphans, status)]


def test_nulls_are_only_reported_by_not_null(spark):
    df = frame(spark, ("a", None), ("b", None), ("c", 1), ("d", 1), ("e", 2))
    assert rows(quality.unique(df, "v")) == [(1, 2)]
    assert rows(quality.accepted_values(df, "v", [1])) == [("e", 2)]
    assert quality.not_null(df, "v").count() == 2
    assert rows(quality.null_counts(df, ["k", "v"])) == [("k", 0), ("v", 2)]
    assert rows(quality.expression_is_true(df, "v < 2").select("k")) == [("a",), ("b",), ("e",)]


@pytest.mark.parametrize(("days", "status"), [(74, "pass"), (75, "pass"), (76, "warn"), (120, "warn"), (121, "error")])
def test_freshness(spark, days, status):
    now = datetime(2025, 6, 1)
    df = spark.createDataFrame([(now - timedelta(days=days),), (now - timedelta(days=400),)], "at timestamp")
    assert quality.freshness(df, "at", now).first().status == status


def test_empty_tables_are_errors(spark):
    empty = spark.createDataFrame([], "at timestamp, period string")
    assert quality.freshness(empty, "at", datetime(2025, 6, 1)).first().status == "error"
    with pytest.raises(ValueError, match="empty"):
        quality.verify_load(empty)
    with pytest.raises(ValueError, match="at least"):
        quality.verify_min_rows(empty)


def test_failing_rows_are_stored_and_cleared(spark, db):
    def run(df):
        tests = [quality.not_null_test("v_present", df, "v"), quality.unique_test("k_unique", df, "k")]
        return rows(quality.run_tests(spark, tests, db))

    assert run(frame(spark, ("a", None), ("a", 1))) == [("k_unique", 1, "error"), ("v_present", 1, "error")]
    assert rows(spark.table(f"{db}.v_present")) == [("a", None)]
    assert run(frame(spark, ("a", 1))) == [("k_unique", 0, "pass"), ("v_present", 0, "pass")]
    assert spark.table(f"{db}.v_present").count() == 0


@pytest.mark.parametrize("select", ["k", "k, v, 1 AS extra", "k, CAST(v AS INT) AS v"])
def test_contract_refuses_other_schemas(spark, select):
    with pytest.raises(SchemaMismatch):
        enforce_contract(frame(spark, ("a", 1)).selectExpr(*select.split(", ")), CONTRACT)


def test_contract_orders_columns(spark):
    assert enforce_contract(frame(spark, ("a", 1)).select("v", "k"), CONTRACT).columns == ["k", "v"]


def test_null_in_required_column_keeps_the_old_table(spark, db):
    table = f"{db}.t"
    build_table(spark, table, frame(spark, ("a", None)), CONTRACT)
    broken = frame(spark, (None, 1), ("b", 2))
    assert rows(null_violations(broken, CONTRACT)) == [("k", 1)]
    with pytest.raises(ValueError, match="not null"):
        build_table(spark, table, broken, CONTRACT)
    assert rows(spark.table(table)) == [("a", None)]


def test_stored_failures_are_counted_as_written(spark, db):
    table = f"{db}.failing"
    frame = spark.sql("SELECT * FROM VALUES (1, 'a', 'p1'), (2, NULL, 'p1'), (2, 'z', 'p2'), (NULL, NULL, 'p2') AS t(id, name, part)")

    def tests(rows_):
        return [
            quality.not_null_test("id_there", rows_, "id"), quality.not_null_test("name_there", rows_, "name"),
            quality.accepted_values_test("name_known", rows_, "name", ["a"]),
        ]

    groups = [quality.unique_test("id_once", frame, "id"), quality.relationships_test("id_known", frame, "id", spark.range(2), "id")]
    report = rows(quality.run_and_store(spark, table, [*tests(frame), *groups]))
    assert report == [("id_known", 2, "warn"), ("id_once", 1, "error"), ("id_there", 1, "error"), ("name_known", 1, "error"), ("name_there", 2, "error")]
    stored = spark.table(table)
    assert rows(stored.groupBy("test").sum("weight")) == [(n, k) for n, k, _ in report]
    assert {r.failing for r in stored.where("test = 'name_known'").collect()} == {'{"id":2,"name":"z","part":"p2"}'}
    again = rows(quality.run_and_store(spark, table, tests(frame.where("part = 'p1'"))))
    assert again == [("id_there", 0, "pass"), ("name_known", 0, "pass"), ("name_there", 1, "error")] and spark.table(table).count() == 1
    with pytest.raises(ValueError, match="unique"):
        quality.run_and_store(spark, table, tests(frame) * 2)
    with pytest.raises(Exception, match="broken|DIVIDE"):
        quality.run_and_store(spark, table, [quality.DataTest("broken", frame, F.expr("1 / (id - id) > 0"))])
    assert spark.table(table).count() == 1  # a run that fails leaves the last one's rows


def test_changed_partitions_alone_are_tested(spark, db):
    table = f"{db}.parts"
    before = spark.sql("SELECT * FROM VALUES (1, 'p1'), (NULL, 'p1'), (NULL, 'p2') AS t(id, part)")
    after = spark.sql("SELECT * FROM VALUES (1, 'p1'), (2, 'p1'), (3, 'p3'), (NULL, 'p3') AS t(id, part)")

    def tests_of(frame):
        return lambda parts: [quality.not_null_test("id_there", frame.where(F.col("part").isin(parts)), "id")]

    assert rows(quality.run_on_partitions(spark, table, tests_of(before), "part", ["p1", "p2"])) == [("id_there", 2, "error")]
    assert rows(quality.run_on_partitions(spark, table, tests_of(after), "part", ["p1", "p3"])) == [("id_there", 2, "error")]
    assert sorted(r.part for r in spark.table(table).collect()) == ["p2", "p3"]
