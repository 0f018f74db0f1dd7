"""Names over snapshots: one switch for many partitions and for other columns, statistics without a scan."""

from datetime import datetime, timedelta, timezone

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tideline.operators import snapshot
from tideline.operators.governance import apply_governance, describe_governance
from tideline.operators.merge import DuplicateKeys, SchemaMismatch, merge_into
from tideline.operators.snapshot import (
    Statistics, expire_snapshots, is_snapshot, manifest, publish, resolve, rows_per_partition, stored_marks, stored_maximum, stored_nulls,
)
from tideline.operators.versions import replace_contents


def facts(spark, *values):
    return spark.createDataFrame(values, "key string, feed string, amount double, period string")


KEPT = Statistics("feed", ("amount",), ("amount",))
FIRST = [("a", "y", 1.0, "2025-01"), ("b", "y", 9.5, "2025-02"), ("c", "g", 10.25, "2025-01"), ("d", "g", None, "2025-01")]


@pytest.fixture
def fact(spark, db):
    name = f"{db}.fact"
    merge_into(spark, name, facts(spark, *FIRST), "key", "period", snapshot=True, statistics=KEPT)
    return name


def test_moved_keys_change_in_one_switch(spark, fact, monkeypatch):
    before, seen = rows(spark.table(fact)), []
    switched = snapshot._switch

    def watched(*args):
        seen.append(rows(spark.table(fact)))  # a reader just before the statement
        switched(*args)

    monkeypatch.setattr(snapshot, "_switch", watched)
    earlier = spark.table(fact)
    merge_into(spark, fact, facts(spark, ("a", "y", 2.0, "2025-03"), ("c", "g", 3.0, "2025-03")), "key", "period")
    assert seen == [before] and rows(earlier) == before
    assert rows(spark.table(fact)) == sorted([("a", "y", 2.0, "2025-03"), ("b", "y", 9.5, "2025-02"), ("c", "g", 3.0, "2025-03"), FIRST[3]], key=str)
    assert is_snapshot(spark, fact) and resolve(spark, fact) != fact


def test_a_switch_that_fails_leaves_the_name_as_it_was(spark, fact, monkeypatch):
    before = rows(spark.table(fact))
    monkeypatch.setattr(snapshot, "point_partitions_to", lambda *a: (_ for _ in ()).throw(RuntimeError("catalog lost")))
    with pytest.raises(RuntimeError):
        merge_into(spark, fact, facts(spark, ("a", "y", 2.0, "2025-03")), "key", "period")
    monkeypatch.undo()
    assert rows(spark.table(fact)) == before
    merge_into(spark, fact, facts(spark, ("a", "y", 2.0, "2025-03")), "key", "period")
    assert ("a", "y", 2.0, "2025-03") in rows(spark.table(fact))


def test_emptied_partitions_leave_the_manifest(spark, fact):
    merge_into(spark, fact, facts(spark, ("b", "y", 1.0, "2025-01")), "key", "period")
    assert {r.partition for r in manifest(spark, fact).collect()} == {"period=2025-01"}
    merge_into(spark, fact, facts(spark, ("z", "y", 1.0, "2025-01")), "key", "period", replaces=["2025-01"])
    assert rows(spark.table(fact)) == [("z", "y", 1.0, "2025-01")]


def test_statistics_equal_a_scan(spark, fact):
    for step in (None, [("e", "g", 4.0, "2025-04"), ("a", "y", None, "2025-02")], [("e", "g", 40.0, "2025-01")]):
        if step:
            merge_into(spark, fact, facts(spark, *step), "key", "period")
        table = spark.table(fact)
        assert stored_marks(spark, fact, "period") == dict(rows(table.groupBy("feed").agg(F.max("period"))))
        assert rows(rows_per_partition(spark, fact, "period")) == rows(table.groupBy("period").count())
        assert stored_maximum(spark, fact, "amount") == table.agg(F.max("amount")).first()[0]
        assert stored_nulls(spark, fact, "amount") == table.where("amount IS NULL").count()


def test_a_full_refresh_may_change_columns_and_an_increment_may_not(spark, fact):
    wider = facts(spark, *FIRST).select("key", "feed", F.col("amount").cast("decimal(9,2)").alias("amount"), F.lit(1).alias("more"), "period")
    with pytest.raises(SchemaMismatch):
        merge_into(spark, fact, wider, "key", "period")
    with pytest.raises(DuplicateKeys):
        merge_into(spark, fact, wider.union(wider), "key", "period", full_refresh=True)
    assert rows(spark.table(fact)) == sorted(FIRST, key=str)  # a refused run changes nothing
    merge_into(spark, fact, wider, "key", "period", full_refresh=True)
    assert spark.table(fact).dtypes == wider.dtypes and spark.table(fact).count() == 4
    assert stored_marks(spark, fact, "period") == {"y": "2025-02", "g": "2025-01"}  # what is kept stays so


def test_a_table_made_before_becomes_a_name(spark, db):
    name = f"{db}.old"
    replace_contents(spark, name, spark.range(3))
    earlier = spark.table(name)
    publish(spark, name, spark.range(5).withColumn("more", F.lit(1)))
    assert spark.table(name).count() == 5 and spark.table(name).columns == ["id", "more"]
    assert earlier.count() == 3
    with pytest.raises(ValueError):
        publish(spark, name, spark.range(2).withColumn("more", F.lit(None).cast("int")), not_null=["more"])
    assert spark.table(name).count() == 5


def test_old_snapshots_go_a_week_later_with_their_tables(spark, fact, db):
    first = resolve(spark, fact)
    for day in (5, 6):
        merge_into(spark, fact, facts(spark, ("a", "y", float(day), "2025-01")), "key", "period")
    now = datetime.now(timezone.utc)
    before = rows(spark.table(fact))
    assert expire_snapshots(spark, fact, 7, now) == []
    assert len(expire_snapshots(spark, fact, 7, now + timedelta(days=8))) >= 1
    assert rows(spark.table(fact)) == before
    assert spark.catalog.tableExists(first)  # 2025-02 is still read from the first version


def test_tags_outlive_a_snapshot_and_columns_have_tags(spark, fact):
    apply_governance(spark, fact, {"dataOwner": "me"}, "facts", {"amount": "money"}, {"amount": {"class": "internal"}})
    merge_into(spark, fact, facts(spark, ("q", "y", 1.0, "2025-01")), "key", "period")
    tags = {tuple(r) for r in describe_governance(spark, fact).where("kind <> 'column'").collect()}
    assert tags == {("tag", "dataOwner", "me"), ("column tag", "amount.class", "internal")}
    with pytest.raises(ValueError, match="no columns"):
        apply_governance(spark, fact, column_tags={"nothing": {"a": "b"}})


def test_no_rows_make_an_empty_name(spark, db):
    name = f"{db}.none"
    merge_into(spark, name, facts(spark), "key", "period", snapshot=True, statistics=KEPT)
    assert spark.table(name).count() == 0 and stored_marks(spark, name, "period") == {}
    merge_into(spark, name, facts(spark, *FIRST), "key", "period")
    assert spark.table(name).count() == 4
