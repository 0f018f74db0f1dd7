"""Folding the batches of a raw table: the same rows before, between and after."""

from datetime import datetime, timedelta, timezone

import pytest
from conftest import rows
from test_ingest import ints, write

from tideline.operators import fold, ingest
from tideline.operators.fold import expire_folded, fold_batches, partition_sizes
from tideline.operators.ingest import (
    BATCH, committed, copy_into, latest_files, partition_statistics, reset, rows_of_batches, rows_per_loaded_period, stored_partitions,
)


def load(spark, raw, folder):
    return copy_into(spark, raw, str(folder), actor="me").batch_id


@pytest.fixture
def loaded(spark, db, tmp_path):
    raw, batches, tmp_path = f"{db}.raw", [], tmp_path / "dataset=x"
    for n in range(4):
        write(tmp_path, "2025-01", f"a{n}.parquet", id=ints(n))
        if n % 2:
            write(tmp_path, "2025-02", f"b{n}.parquet", id=ints(10 + n, 20 + n))
        batches.append(load(spark, raw, tmp_path))
    return raw, batches, tmp_path


def contents(spark, raw):
    return rows(committed(spark, raw).select("id", "period", "_loaded_from", "_loaded_at"))


def test_a_fold_leaves_one_file_per_period_and_the_same_rows(spark, loaded):
    raw, batches, _ = loaded
    before = contents(spark, raw)
    running = committed(spark, raw).select("id")  # a reader that began before
    assert fold_batches(spark, raw) == 2
    assert contents(spark, raw) == before and running.count() == len(before)
    assert {(r.partition, r.files) for r in partition_sizes(spark, raw).collect()} == {("period=2025-01", 1), ("period=2025-02", 1)}
    assert fold_batches(spark, raw) == 0
    assert expire_folded(spark, raw) == 0  # not yet a week old
    assert expire_folded(spark, raw, now=datetime.now(timezone.utc) + timedelta(days=8)) == 6
    assert contents(spark, raw) == before
    assert spark.table(raw).count() == len(before)


def test_rows_keep_their_batch_through_folds_of_folds(spark, loaded):
    raw, batches, folder = loaded
    want = {b: rows(rows_of_batches(spark, raw, [b]).select("id")) for b in batches}
    fold_batches(spark, raw)
    write(folder, "2025-01", "late.parquet", id=ints(99))
    late = load(spark, raw, folder)
    assert fold_batches(spark, raw) == 1  # only the month that got another file
    expire_folded(spark, raw, retain_days=0)
    assert {b: rows(rows_of_batches(spark, raw, [b]).select("id")) for b in batches} == want
    assert rows(rows_of_batches(spark, raw, [late]).select("id")) == [(99,)]
    assert rows(rows_of_batches(spark, raw, batches[:2]).select("id")) == sorted(want[batches[0]] + want[batches[1]])


def test_latest_files_and_loads_are_as_before(spark, loaded):
    raw, _, folder = loaded
    write(folder, "2025-01", "a0.parquet", id=ints(7, 8, 9))  # restated in place
    load(spark, raw, folder)
    before = rows(latest_files(spark, raw).select("id"))
    fold_batches(spark, raw)
    expire_folded(spark, raw, retain_days=0)
    assert rows(latest_files(spark, raw).select("id")) == before and (0,) not in before and (7,) in before
    assert copy_into(spark, raw, str(folder)).files_loaded == 0
    reset(spark, raw)
    assert committed(spark, raw).count() == 0
    assert copy_into(spark, raw, str(folder)).rows_inserted == committed(spark, raw).count() > 0


def test_a_fold_that_stops_before_its_ledger_row_changes_nothing(spark, loaded, monkeypatch):
    raw, _, folder = loaded
    before = contents(spark, raw)
    monkeypatch.setattr(fold, "_known_rows", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        fold_batches(spark, raw)
    assert contents(spark, raw) == before
    assert stored_partitions(spark, raw).where("state = 'unfinished'").count() == 2
    monkeypatch.undo()
    assert fold_batches(spark, raw) == 2 and contents(spark, raw) == before
    assert stored_partitions(spark, raw).where("state = 'unfinished'").count() == 0


def test_a_fold_with_other_counts_than_the_loads_is_refused(spark, loaded, monkeypatch):
    raw, _, _ = loaded
    known = fold._known_rows
    monkeypatch.setattr(fold, "_known_rows", lambda s, t: known(s, t).selectExpr("partition", BATCH, "row_count + 1 AS row_count"))
    with pytest.raises(RuntimeError, match="became"):
        fold_batches(spark, raw)


def test_large_partitions_are_left_and_small_ones_cut_to_the_target(spark, db, tmp_path):
    raw, tmp_path = f"{db}.cut", tmp_path / "dataset=x"
    for n in range(6):
        write(tmp_path, "2025-01", f"a{n}.parquet", id=ints(*range(n * 4000, n * 4000 + 4000)))
        load(spark, raw, tmp_path)
    sizes = [r.bytes for r in partition_sizes(spark, raw).collect()]
    assert fold_batches(spark, raw, "id", target_bytes=min(sizes)) == 0  # none is below the target
    target = 3 * max(sizes)
    assert fold_batches(spark, raw, "id", target_bytes=target) == 1
    (held,) = partition_sizes(spark, raw).collect()
    assert 1 <= held.files <= 3 and committed(spark, raw).count() == 24000
    assert fold_batches(spark, raw, "id", target_bytes=target) == 0


def test_statistics_of_loads_need_no_rows(spark, loaded):
    raw, batches, _ = loaded
    want = rows(committed(spark, raw).groupBy("period").count())
    assert rows(rows_per_loaded_period(spark, raw)) == want
    fold_batches(spark, raw)
    assert rows(rows_per_loaded_period(spark, raw)) == want
    newest = partition_statistics(spark, raw).agg({"newest": "max"}).first()[0]
    assert newest == committed(spark, raw).agg({"_loaded_at": "max"}).first()[0]
    spark.sql(f"TRUNCATE TABLE {ingest.ledger_tables(raw)[1]}")  # batches not completed do not count
    assert partition_statistics(spark, raw).count() == 0
