from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tideline.functions import duration_minutes, local_parts, local_to_instant, surrogate_key, unknown_label
from tideline.operators.conform import Field, conform, union_feeds

NEW_YORK = "America/New_York"


@pytest.mark.parametrize(
    ("clock", "instant"),
    [
        ("2025-01-15 12:00:00", datetime(2025, 1, 15, 17)),
        ("2025-11-02 01:30:00", datetime(2025, 11, 2, 5, 30)),  # occurs twice: the earlier one
        ("2025-03-09 02:30:00", datetime(2025, 3, 9, 7, 30)),  # never occurs
    ],
)
def test_wall_clock_becomes_instant(spark, clock, instant):
    df = spark.sql(f"SELECT timestamp_ntz'{clock}' AS c").select(local_to_instant(F.col("c"), NEW_YORK))
    assert df.first()[0] == instant


def test_duration_counts_whole_seconds_and_keeps_negatives(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, timestamp'2025-01-01 00:00:00', timestamp'2025-01-01 00:00:01.9'), "
        "(2, timestamp'2025-01-01 00:10:00', timestamp'2025-01-01 00:00:00') AS t(id, a, b)"
    )
    assert rows(df.select("id", duration_minutes(F.col("a"), F.col("b")))) == [(1, 0.016667), (2, -10.0)]


def test_day_of_week_starts_on_sunday(spark):
    parts = local_parts(F.col("c"))
    df = spark.sql("SELECT timestamp_ntz'2025-03-09 23:15:00' AS c").select(*parts.values())
    assert tuple(df.first()) == (date(2025, 3, 9), 23, 1)


def test_null_in_a_key_is_not_skipped(spark):
    df = spark.sql("SELECT * FROM VALUES ('a', CAST(NULL AS STRING), 'b'), ('a', 'b', CAST(NULL AS STRING)) AS t(x, y, z)")
    keys = {r[0] for r in df.select(surrogate_key(["x", "y", "z"])).collect()}
    assert len(keys) == 2


def test_label_of_a_null_code_is_null(spark):
    df = spark.sql("SELECT CAST(NULL AS BIGINT) AS c UNION ALL SELECT 9")
    assert {r[0] for r in df.select(unknown_label("vendor", F.col("c"))).collect()} == {None, "Unknown vendor (9)"}


def test_conform_casts_fills_and_aligns(spark):
    fields = [
        Field("feed", "string", value="a"),
        Field("id", "bigint", "ID"),
        Field("fee", "double", "fee", default=0),
        Field("other", "double"),
    ]
    without = conform(spark.sql("SELECT 1 AS id"), fields)
    with_null = conform(spark.sql("SELECT 2 AS id, CAST(NULL AS FLOAT) AS fee"), fields)
    assert without.dtypes == [("feed", "string"), ("id", "bigint"), ("fee", "double"), ("other", "double")]
    assert rows(union_feeds([without, with_null])) == [("a", 1, 0.0, None), ("a", 2, 0.0, None)]


def test_missing_column_without_default_is_an_error(spark):
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        conform(spark.sql("SELECT 1 AS id"), [Field("x", "bigint", "absent")])


def test_same_attributes_in_two_feeds_have_two_keys(spark):
    df = spark.sql("SELECT 1 AS a")
    keys = [conform(df, [Field("k", "string", key_of=(F.lit(feed), "a"))]).first()[0] for feed in ("x", "y")]
    assert keys[0] != keys[1]
