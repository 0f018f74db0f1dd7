import hashlib
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators import ingest
from tideline.operators.ingest import committed, copy_into, latest_files, loaded_files, reset
from tideline.sources.drift import read_evolving, schema_drift, schema_fingerprints, widen_schemas
from tideline.sources.files import check_sizes, list_files, scan_parquet
from tideline.streaming import stream_copy_into


def write(folder, period, name="part.parquet", **columns):
    path = folder / f"period={period}"
    path.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.table(columns), path / name)
    return path / name


def ints(*values):
    return pa.array(values, pa.int32())


def longs(*values):
    return pa.array(values, pa.int64())


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "dataset=x"
    write(folder, "2025-01", id=ints(1, 2), fare=pa.array([1.0, 2.0]))
    return folder


def load(spark, table, folder):
    return copy_into(spark, table, str(folder), actor="me")


def test_files_load_once(spark, db, landing):
    raw = f"{db}.raw"
    first = load(spark, raw, landing)
    assert (first.files_loaded, first.rows_inserted, first.files_skipped) == (1, 2, 0)
    again = load(spark, raw, landing)
    assert (again.files_loaded, again.rows_inserted, again.files_skipped) == (0, 0, 1)
    write(landing, "2025-02", id=ints(3), fare=pa.array([3.0]))
    third = load(spark, raw, landing)
    assert (third.files_loaded, third.rows_inserted, third.files_skipped) == (1, 1, 1)
    table = spark.table(raw)
    assert rows(table.select("id", "period")) == [(1, "2025-01"), (2, "2025-01"), (3, "2025-02")]
    assert table.where("_loaded_by = 'me' AND _loaded_from LIKE '%part.parquet' AND _source_modified_at IS NOT NULL").count() == 3


def test_file_replaced_at_its_path_is_a_new_batch(spark, db, landing):
    raw = f"{db}.raw"
    load(spark, raw, landing)
    path = write(landing, "2025-01", id=ints(1, 2, 3), fare=pa.array([1.0, 2.0, 9.0]))
    os.utime(path, (2_000_000_000, 2_000_000_000))
    assert load(spark, raw, landing).files_loaded == 1
    assert spark.table(raw).count() == 5
    assert rows(latest_files(spark, raw).select("id")) == [(1,), (2,), (3,)]


def test_split_loads_and_late_files_hide_no_rows(spark, db, tmp_path):
    raw, folder = f"{db}.raw", tmp_path / "many" / "period=2025-01"
    folder.mkdir(parents=True)
    for i in range(5):
        pq.write_table(pa.table({"id": ints(i)}), folder / f"{i}.parquet")
    ingest.copy_into(spark, raw, str(folder.parent), files_per_batch=2)
    assert rows(latest_files(spark, raw).select("id")) == [(i,) for i in range(5)]
    pq.write_table(pa.table({"id": ints(5)}), folder / "5.parquet")
    pq.write_table(pa.table({"id": ints(10)}), folder / "0.parquet")
    os.utime(folder / "0.parquet", (2_000_000_000, 2_000_000_000))
    ingest.copy_into(spark, raw, str(folder.parent))
    assert rows(latest_files(spark, raw).select("id")) == [(i,) for i in (1, 2, 3, 4, 5, 10)]
    (folder / "1.parquet").unlink()
    present = list_files(spark, str(folder.parent), "*.parquet")
    assert rows(latest_files(spark, raw, present).select("id")) == [(i,) for i in (2, 3, 4, 5, 10)]


def test_reset_broken_off_half_way_still_reloads(spark, db, landing, monkeypatch):
    raw = f"{db}.raw"
    load(spark, raw, landing)
    monkeypatch.setattr(ingest, "drop_partitions", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        ingest.reset(spark, raw)
    monkeypatch.undo()
    assert load(spark, raw, landing).files_loaded == 1
    assert spark.table(raw).count() == 2


def test_crash_between_rows_and_ledger_loads_once(spark, db, landing, monkeypatch):
    raw = f"{db}.raw"
    load(spark, raw, landing)
    write(landing, "2025-02", id=ints(3), fare=pa.array([3.0]))
    monkeypatch.setattr(ingest, "record_batch", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        load(spark, raw, landing)
    monkeypatch.undo()
    assert spark.table(raw).count() == 3  # written, not committed
    assert committed(spark, raw).count() == 2
    assert load(spark, raw, landing).files_loaded == 1
    assert rows(spark.table(raw).select("id")) == [(1,), (2,), (3,)]
    assert loaded_files(spark, raw).count() == 2


def test_late_column_and_wider_integer(spark, db, landing):
    raw = f"{db}.raw"
    write(landing, "2025-02", id=longs(3), fare=pa.array([3.0]), fee=pa.array([0.5]))
    load(spark, raw, landing)
    assert dict(spark.table(raw).dtypes)["id"] == "bigint"
    write(landing, "2025-03", id=ints(4), extra=pa.array(["x"]))
    load(spark, raw, landing)
    assert rows(spark.table(raw).select("id", "fare", "fee", "extra"), "id") == [
        (1, 1.0, None, None), (2, 2.0, None, None), (3, 3.0, 0.5, None), (4, None, None, "x"),
    ]


def test_wider_integer_into_a_narrow_column_is_checked(spark, db, landing):
    raw = f"{db}.raw"
    load(spark, raw, landing)
    write(landing, "2025-02", id=longs(3), fare=pa.array([3.0]))
    load(spark, raw, landing)
    assert spark.table(raw).count() == 3
    write(landing, "2025-03", id=longs(2**40), fare=pa.array([3.0]))
    with pytest.raises(Exception, match="OVERFLOW"):
        load(spark, raw, landing)
    assert committed(spark, raw).count() == 3


def test_types_without_a_common_one_are_refused(spark, db, landing):
    raw = f"{db}.raw"
    load(spark, raw, landing)
    write(landing, "2025-02", id=pa.array(["x"]), fare=pa.array([3.0]))
    with pytest.raises(ValueError, match="id"):
        load(spark, raw, landing)
    assert spark.table(raw).count() == 2


def test_many_files_load_in_several_batches(spark, db, landing):
    raw = f"{db}.raw"
    for month in range(2, 6):
        write(landing, f"2025-0{month}", id=ints(month), fare=pa.array([1.0]))
    summary = copy_into(spark, raw, str(landing), actor="me", files_per_batch=2)
    assert (summary.files_loaded, summary.rows_inserted, summary.files_skipped) == (5, 6, 0)
    assert spark.table(raw).select("_batch_id").distinct().count() == 3
    again = copy_into(spark, raw, str(landing), actor="me", files_per_batch=2)
    assert (again.files_loaded, again.files_skipped) == (0, 5)


def test_older_files_can_be_left_out_of_the_listing(spark, db, landing):
    raw = f"{db}.raw"
    old = write(landing, "2020-01", id=ints(9), fare=pa.array([1.0]))
    os.utime(old, (1_600_000_000, 1_600_000_000))
    assert copy_into(spark, raw, str(landing), modified_after="2024-01-01T00:00:00").files_loaded == 1
    assert copy_into(spark, raw, str(landing)).files_loaded == 1


def test_reset_forgets_and_keep_ledger_does_not(spark, db, landing):
    raw = f"{db}.raw"
    load(spark, raw, landing)
    reset(spark, raw, keep_ledger=True)
    assert spark.table(raw).count() == 0
    assert load(spark, raw, landing).files_loaded == 0
    reset(spark, raw)
    assert load(spark, raw, landing).rows_inserted == 2


def test_empty_folder_is_a_load_of_nothing(spark, db, tmp_path):
    (tmp_path / "none").mkdir()
    assert load(spark, f"{db}.raw", tmp_path / "none").files_loaded == 0


def test_fingerprint_ignores_order_and_type_hash_sees_types(spark, tmp_path):
    write(tmp_path, "1", a=ints(1), b=ints(1))
    write(tmp_path, "2", b=ints(1), a=ints(1))
    write(tmp_path, "3", a=longs(1), b=ints(1))
    write(tmp_path, "4", a=ints(1), c=ints(1))
    prints = schema_fingerprints(list_files(spark, str(tmp_path), "*.parquet")).withColumn(
        "period", F.regexp_extract("path", "period=(.)", 1)
    )
    by_period = {r.period: r for r in prints.collect()}
    assert by_period["1"].schema_hash == hashlib.sha256(b"a,b").hexdigest()[:16]
    assert by_period["1"].schema_hash == by_period["2"].schema_hash == by_period["3"].schema_hash
    assert by_period["1"].type_hash == by_period["2"].type_hash != by_period["3"].type_hash
    tagged = prints.withColumn("dataset", F.lit("x"))
    assert schema_drift(tagged, tagged.limit(0)).isEmpty()  # first run
    drift = schema_drift(tagged, tagged.where("period = '1'"))
    assert [r.period for r in drift.collect()] == ["4"]


def test_one_scan_over_widened_files(spark, tmp_path):
    write(tmp_path, "1", id=ints(1), x=pa.array([1.5], pa.float32()))
    write(tmp_path, "2", id=longs(2**40), x=pa.array([2.5]), fee=ints(7))
    df = read_evolving(spark, list_files(spark, str(tmp_path), "*.parquet"), str(tmp_path))
    assert df.dtypes == [("id", "bigint"), ("x", "double"), ("fee", "int"), ("period", "string")]
    assert rows(df) == [(1, 1.5, None, "1"), (2**40, 2.5, 7, "2")]


def test_widening_never_loses_digits(spark):
    longs_, doubles = spark.sql("SELECT 1L AS a").schema, spark.sql("SELECT CAST(1 AS DOUBLE) AS a").schema
    with pytest.raises(ValueError, match="no lossless type"):
        widen_schemas([longs_, doubles])


def test_period_of_the_folder_stays_text(spark, landing):
    assert dict(scan_parquet(spark, str(landing)).dtypes)["period"] == "string"


def test_sizes(spark, landing):
    files = list_files(spark, str(landing), "*.parquet")
    right = files.select("path", "length")
    check_sizes(files, right)
    check_sizes(files, right.withColumn("length", F.lit(0)))
    with pytest.raises(ValueError, match="size mismatch"):
        check_sizes(files, right.withColumn("length", F.lit(1)))


def test_stream_loads_each_file_once(spark, landing, tmp_path):
    schema = spark.read.parquet(str(landing)).schema
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    for _ in range(2):
        stream_copy_into(spark, str(landing), target, checkpoint, schema, actor="me")
    assert spark.read.parquet(target).count() == 2
    write(landing, "2025-02", id=ints(3), fare=pa.array([3.0]))
    stream_copy_into(spark, str(landing), target, checkpoint, schema, actor="me")
    assert rows(spark.read.parquet(target).select("id", "period")) == [(1, "2025-01"), (2, "2025-01"), (3, "2025-02")]


def test_stream_of_versions_reads_replaced_files_and_survives_a_stop(spark, landing, tmp_path, monkeypatch):
    from tideline.streaming import restated

    schema = T.StructType.fromDDL("id int, fare double, period string")
    target, state = f"{tmp_path}/streamed", f"{tmp_path}/state"
    run = lambda: restated.stream_versions(spark, str(landing), target, state, schema, actor="me")
    assert run() == 1 and run() == 0
    path = write(landing, "2025-01", id=ints(1, 2, 3), fare=pa.array([1.0, 2.0, 9.0]))
    os.utime(path, (2_000_000_000, 2_000_000_000))
    write(landing, "2025-02", id=ints(7), fare=pa.array([7.0]))
    lineage = restated.with_lineage
    monkeypatch.setattr(restated, "with_lineage", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(Exception, match="stopped"):
        run()  # noted, not loaded
    assert restated.newest_versions(spark, target, schema).count() == 2
    monkeypatch.setattr(restated, "with_lineage", lineage)
    assert run() == 0  # nothing new is noted; the restart loads what was
    assert rows(restated.newest_versions(spark, target, schema).select("id", "period")) == [(1, "2025-01"), (2, "2025-01"), (3, "2025-01"), (7, "2025-02")]
    assert restated.all_versions(spark, target, schema).count() == 6
    assert run() == 0 and restated.all_versions(spark, target, schema).count() == 6
