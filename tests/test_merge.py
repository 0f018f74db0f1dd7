import pytest
from conftest import rows

from tideline.operators import versions
from tideline.operators.contract import SchemaMismatch
from tideline.operators.merge import DuplicateKeys, high_mark, high_marks, merge_into, since, since_per_feed

SCHEMA = "k string, v int, period string"


def merge(spark, table, data, **options):
    return merge_into(spark, table, spark.createDataFrame(data, SCHEMA), "k", "period", **options)


@pytest.fixture
def target(spark, db):
    table = f"{db}.fact"
    merge(spark, table, [("a", 1, "2025-01"), ("b", 1, "2025-01"), ("c", 1, "2025-02")])
    return table


def test_matched_replaced_others_inserted_twice_is_once(spark, target):
    for _ in range(2):
        merge(spark, target, [("c", 2, "2025-02"), ("d", 2, "2025-03")])
        assert rows(spark.table(target)) == [
            ("a", 1, "2025-01"), ("b", 1, "2025-01"), ("c", 2, "2025-02"), ("d", 2, "2025-03"),
        ]


def test_key_that_moves_leaves_its_old_partition(spark, target):
    result = merge(spark, target, [("c", 2, "2025-01")])
    assert rows(spark.table(target)) == [("a", 1, "2025-01"), ("b", 1, "2025-01"), ("c", 2, "2025-01")]
    assert versions.registered_partitions(spark, target) == {"period=2025-01"}
    assert result.partitions_rewritten == 1


def test_untouched_partitions_keep_their_files(spark, target):
    before = set(spark.table(target).where("period = '2025-01'").inputFiles())
    merge(spark, target, [("c", 2, "2025-02")])
    assert set(spark.table(target).where("period = '2025-01'").inputFiles()) == before


def test_crash_while_switching_is_finished_by_the_next_run(spark, target, monkeypatch):
    def crash(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(versions, "drop_partitions", crash)
    with pytest.raises(RuntimeError):
        merge(spark, target, [("c", 2, "2025-01")])
    monkeypatch.undo()
    assert spark.table(target).where("k = 'c'").count() == 2  # between the two steps
    assert versions.finish_pending(spark, target)
    assert rows(spark.table(target)) == [("a", 1, "2025-01"), ("b", 1, "2025-01"), ("c", 2, "2025-01")]
    assert not versions.finish_pending(spark, target)


def test_crash_before_switching_changes_nothing(spark, target, monkeypatch):
    before = rows(spark.table(target))
    monkeypatch.setattr("tideline.operators.merge.switch_partitions", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        merge(spark, target, [("a", 5, "2025-01")])
    assert rows(spark.table(target)) == before


def test_repeated_source_keys(spark, target):
    repeated = [("c", 2, "2025-02"), ("c", 3, "2025-02")]
    before = rows(spark.table(target))
    with pytest.raises(DuplicateKeys):
        merge(spark, target, repeated)
    assert rows(spark.table(target)) == before
    merge(spark, target, repeated, latest_by=["v"])
    assert spark.table(target).where("k = 'c'").first().v == 3


def test_first_build_with_repeated_keys_publishes_nothing(spark, db):
    with pytest.raises(DuplicateKeys):
        merge(spark, f"{db}.fresh", [("c", 2, "2025-02"), ("c", 3, "2025-02")])
    assert not spark.catalog.tableExists(f"{db}.fresh")


@pytest.mark.parametrize(
    "schema", ["k string, v int, period string, extra int", "k string, period string", "k string, v long, period string"]
)
def test_changed_schema_fails_before_writing(spark, target, schema):
    before = rows(spark.table(target))
    values = {"k": "a", "v": 1, "period": "2025-01", "extra": 1}
    row = tuple(values[column.split()[0]] for column in schema.split(", "))
    with pytest.raises(SchemaMismatch):
        merge_into(spark, target, spark.createDataFrame([row], schema), "k", "period")
    assert rows(spark.table(target)) == before


def test_null_in_required_column_stops_the_merge(spark, target):
    before = rows(spark.table(target))
    with pytest.raises(ValueError, match="not null"):
        merge(spark, target, [("a", None, "2025-01")], not_null=["v"])
    assert rows(spark.table(target)) == before


def test_full_refresh_replaces_everything(spark, target):
    merge(spark, target, [("z", 9, "2025-09")], full_refresh=True)
    assert rows(spark.table(target)) == [("z", 9, "2025-09")]


def test_empty_source_changes_nothing(spark, target):
    assert merge(spark, target, []).partitions_rewritten == 0


def test_marks(spark, target, db):
    assert high_mark(spark, target, "period") == "2025-02"
    assert high_mark(spark, target, "k") == "c"
    assert high_mark(spark, f"{db}.absent", "period") == "1900-01"
    pruned = spark.table(target).where(since("period", high_mark(spark, target, "period")))
    assert rows(pruned) == [("c", 1, "2025-02")]  # the mark's own period is included
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(period" in plan
    marks = high_marks(spark.table(target), "k", "period")
    assert marks == {"a": "2025-01", "b": "2025-01", "c": "2025-02"}
    source = spark.createDataFrame([("a", 1, "2024-12"), ("c", 1, "2025-02"), ("new", 1, "2020-01")], SCHEMA)
    assert [r[0] for r in rows(source.where(since_per_feed("k", "period", marks)))] == ["c", "new"]


def test_a_restated_partition_loses_what_the_source_dropped(spark, db):
    table = f"{db}.restated"
    first = spark.sql("SELECT * FROM VALUES ('a', 1, '2025-01'), ('b', 2, '2025-01'), ('c', 3, '2025-02') AS t(k, v, p)")
    merge_into(spark, table, first, "k", "p")
    again = spark.sql("SELECT * FROM VALUES ('a2', 12, '2025-01'), ('b', 2, '2025-01') AS t(k, v, p)")
    merge_into(spark, table, again, "k", "p", replaces=["2025-01"])
    assert rows(spark.table(table)) == [("a2", 12, "2025-01"), ("b", 2, "2025-01"), ("c", 3, "2025-02")]
    merge_into(spark, table, again.limit(0), "k", "p", replaces=["2025-02"])
    assert rows(spark.table(table).select("k")) == [("a2",), ("b",)]


def test_matches_are_sought_in_the_dates_of_the_source_only(spark, db):
    from datetime import date

    from tideline.operators.merge import matched_partitions, within_dates

    table, schema = f"{db}.dated", "k string, d date, v int, p string"
    days = [date(2024, m, 10) for m in range(1, 13)]
    first = spark.createDataFrame([(f"k{i}", d, 1, f"2024-{d.month:02d}") for i, d in enumerate(days)] + [("none", None, 1, "2024-01")], schema)
    merge_into(spark, table, first, "k", "p", key_date="d")
    moved = spark.createDataFrame([("k3", days[3], 2, "2024-09"), ("new", date(1999, 1, 1), 2, "2024-09"), ("none", None, 2, "2024-09")], schema)
    fresh = spark.table(table).limit(0).unionByName(moved)
    plan = matched_partitions(spark.table(table), fresh, "k", "p", "d")._jdf.queryExecution().executedPlan().toString()
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line and "IsNull(d)" in line)
    assert "PushedFilters" in pushed and "GreaterThanOrEqual(d,1999-01-01)" in pushed
    result = merge_into(spark, table, moved, "k", "p", key_date="d")
    held = {r.k: (r.v, r.p) for r in spark.table(table).collect()}
    assert held["k3"] == (2, "2024-09") and held["none"] == (2, "2024-09") and held["new"] == (2, "2024-09")
    assert len(held) == spark.table(table).count() == 14 and result.partitions_rewritten == 2

    dates = spark.createDataFrame([(date(2024, 1, 1 + 2 * i),) for i in range(10)] + [(date(1970, 1, 1),)], "d date")
    wide = spark.sql("SELECT explode(sequence(DATE'1969-12-01', DATE'2024-02-01')) AS d").where(within_dates("d", dates, most=2))
    assert wide.count() == 1 + 19
    with pytest.raises(ValueError):
        within_dates("v", spark.table(table))
