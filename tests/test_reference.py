from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tideline.operators.replace import replace_table
from tideline.operators.versions import create_database
from tideline.plans.runs import reload_seeds
from tideline.sources.candidates import candidate_window, classify_candidates, to_fetch
from tideline.sources.files import scan_csv
from tideline.sources.reference import (
    InvalidReference,
    archive_copy,
    content_changed,
    content_hashes,
    load_seed,
    validate_reference,
)

HEADER = ["LocationID", "Borough"]


def csv(tmp_path, text, encoding="utf-8-sig", name="zones.csv"):
    path = tmp_path / name
    path.write_text(text, encoding=encoding)
    return str(path)


def test_byte_order_mark_and_blanks_are_no_part_of_a_name(spark, tmp_path):
    path = csv(tmp_path, "LocationID, Borough\n1,Bronx\n2,Queens\n")
    assert validate_reference(spark, path, HEADER, min_rows=2) == 2


@pytest.mark.parametrize(
    ("text", "message"),
    [("", "empty"), ("id,Borough\n1,a\n2,b\n", "header"), ("Borough,LocationID\na,1\nb,2\n", "header"), ("LocationID,Borough\n1,a\n", "1 rows")],
)
def test_suspect_files_are_refused(spark, tmp_path, text, message):
    with pytest.raises(InvalidReference, match=message):
        validate_reference(spark, csv(tmp_path, text), HEADER, min_rows=2)


def test_change_is_by_content(spark, tmp_path):
    path = csv(tmp_path, "a\n1\n")
    hashes = content_hashes(spark, path)
    empty = hashes.limit(0).withColumn("landed_at", F.current_timestamp())
    assert content_changed(hashes, empty).first().changed
    landed = spark.createDataFrame([tuple(hashes.first()) + (datetime(2025, 1, 1),)], "path string, sha256 string, landed_at timestamp")
    csv(tmp_path, "a\n1\n")  # written again, same bytes
    assert not content_changed(content_hashes(spark, path), landed).first().changed
    csv(tmp_path, "a\n2\n")
    assert content_changed(content_hashes(spark, path), landed).first().changed


def test_archive_keeps_the_older_copy(spark, tmp_path):
    first = archive_copy(spark.range(2), str(tmp_path), "z", datetime(2025, 1, 1))
    archive_copy(spark.range(3), str(tmp_path), "z", datetime(2025, 1, 2))
    assert spark.read.option("header", True).csv(first).count() == 2
    assert spark.read.option("header", True).csv(f"{tmp_path}/current/z").count() == 3


def test_key_is_cast_not_guessed(spark, tmp_path):
    seed = load_seed(spark, csv(tmp_path, "id,name\n1,a\n,b\n"), "id bigint, name string")
    assert seed.dtypes == [("id", "bigint"), ("name", "string")]
    assert rows(seed) == [(None, "b"), (1, "a")]
    with pytest.raises(Exception, match="MALFORMED"):
        scan_csv(spark, csv(tmp_path, "id,name\nx,a\n", name="bad.csv"), "id bigint, name string").collect()


def test_replace_is_whole_and_stamped(spark, db):
    table = f"{db}.zones"
    replace_table(spark, table, spark.range(5), "ab" * 32)
    replace_table(spark, table, spark.range(3))
    assert rows(spark.table(table).select("id", "_source_sha256")) == [(i, "unknown") for i in range(3)]
    with pytest.raises(ValueError, match="at least"):
        replace_table(spark, table, spark.range(1), min_rows=2)
    assert spark.table(table).count() == 3
    earlier = spark.table(table)
    replace_table(spark, table, spark.range(5).withColumn("more", F.lit(1)))
    assert spark.table(table).columns == ["id", "more", "_loaded_at", "_source_sha256"] and spark.table(table).count() == 5
    assert earlier.count() == 3


def test_window_and_status(spark):
    runs = spark.sql("SELECT date'2026-03-15' AS run_date")
    window = candidate_window(runs, ["yellow", "green"])
    assert window.count() == 16
    periods = sorted({r.period for r in window.collect()})
    assert (periods[0], periods[-1]) == ("2025-06", "2026-01")
    assert "yellow_tripdata_2026-01.parquet" in {r.filename for r in window.collect()}
    entry = "key string, etag string, content_length bigint"
    listing = spark.createDataFrame([("yellow/2026-01", "a", 1), ("yellow/2025-12", "b", 1), ("yellow/2025-11", "c", 1)], entry)
    manifest = spark.createDataFrame([("yellow/2025-12", "b"), ("yellow/2025-11", "old"), ("green/2025-06", "x")], "key string, etag string")
    classified = classify_candidates(window, listing, manifest)
    status = {r.key: r.status for r in classified.collect()}
    assert (status["yellow/2026-01"], status["yellow/2025-12"], status["yellow/2025-11"]) == ("new", "unchanged", "restated")
    assert list(status.values()).count("unpublished") == 13
    assert {r.key for r in to_fetch(classified).collect()} == {"yellow/2026-01", "yellow/2025-11"}


SEEDS = {"vendors": "vendor_id bigint, vendor_name string", "types": "trip_type bigint, label string"}


def test_seeds_are_reloaded_whole_or_not_at_all(spark, tmp_path):
    database = create_database(spark, "seeds_whole", str(tmp_path / "db"))

    def load(vendors, types="trip_type,label\n1,hail\n"):
        csv(tmp_path, vendors, "utf-8", "vendors.csv")
        csv(tmp_path, types, "utf-8", "types.csv")
        spark.catalog.clearCache()
        return {name: rows(df) for name, df in reload_seeds(spark, database, str(tmp_path), SEEDS, datetime(2024, 1, 1)).items()}

    first = load("vendor_id,vendor_name\n1,a\n2,b\n6,\n")
    assert first["vendors"] == [(1, "a"), (2, "b"), (6, None)]
    second = load("vendor_id,vendor_name\n2,c\n")
    assert second == {"vendors": [(2, "c")], "types": [(1, "hail")]}
    refused = [
        ("vendor_id,vendor_name\n3,x\n", "trip_type,label\n1,a\n1,b\n", "types_trip_type_unique"),
        ("vendor_id,vendor_name\n,x\n3,y\n", "trip_type,label\n1,a\n", "vendors_vendor_id_not_null"),
        ("id,vendor_name\n3,x\n", "trip_type,label\n1,a\n", "header"),
        ("vendor_id,vendor_name\n", "trip_type,label\n1,a\n", "0 rows"),
        ("vendor_id,vendor_name\nthree,x\n", "trip_type,label\n1,a\n", "."),
    ]
    for vendors, types, message in refused:
        with pytest.raises(Exception, match=message):
            load(vendors, types)
        assert rows(spark.table(f"{database}.vendors").select("vendor_id", "vendor_name")) == [(2, "c")], message
