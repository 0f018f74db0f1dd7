from datetime import datetime

import pytest
from conftest import rows

from tideline.operators.quality import single_open_version
from tideline.operators.scd2 import END_OF_TIME, START_OF_TIME, open_versions, present_dimension, scd2_apply

T1, T2, T3 = datetime(2024, 1, 1), datetime(2024, 2, 1), datetime(2024, 3, 1)


def look(spark, *vendors):
    return spark.createDataFrame(vendors, "id long, name string, is_unmapped boolean")


def test_versions_over_three_looks(spark):
    history = open_versions(look(spark, (1, "a", False), (2, "b", False), (3, None, True)), "id", T1)
    second = look(spark, (1, "a2", False), (3, "c", False), (4, "d", True))  # 2 is absent
    history = scd2_apply(history, second, "id", ["name"], T2)
    expected = [
        (1, "a", T1, T2), (1, "a2", T2, None), (2, "b", T1, None), (3, None, T1, T2), (3, "c", T2, None), (4, "d", T2, None),
    ]
    assert rows(history.select("id", "name", "valid_from", "valid_to"), "id", "valid_from") == expected
    again = scd2_apply(history, second, "id", ["name"], T3)
    assert rows(again) == rows(history)


def test_other_columns_make_no_version(spark):
    history = open_versions(look(spark, (1, "a", True)), "id", T1)
    again = scd2_apply(history, look(spark, (1, "a", False)), "id", ["name"], T2)
    assert rows(again) == rows(history)


def test_first_version_may_begin_at_the_start_of_time(spark):
    history = open_versions(look(spark, (1, "a", False)), "id", T1)
    history = scd2_apply(history, look(spark, (1, "b", False), (2, "c", False)), "id", ["name"], T2)
    dimension = present_dimension(history, "id", "key", from_start=True)
    assert rows(dimension.select("name", "valid_from")) == [("a", START_OF_TIME), ("b", T2), ("c", START_OF_TIME)]


def test_history_with_other_columns_is_refused(spark):
    history = open_versions(look(spark, (1, "a", False)), "id", T1)
    with pytest.raises(ValueError, match="is_unmapped"):
        scd2_apply(history, look(spark, (1, "a", False)).drop("is_unmapped"), "id", ["name"], T2)


def test_presented_dimension_has_one_open_version(spark):
    history = open_versions(look(spark, (1, "a", False)), "id", T1)
    history = scd2_apply(history, look(spark, (1, "b", False)), "id", ["name"], T2)
    dimension = present_dimension(history, "id", "key")
    assert dimension.columns == ["key", "id", "name", "is_unmapped", "valid_from", "valid_to", "is_current"]
    assert rows(dimension.select("name", "valid_to", "is_current")) == [("a", T2, False), ("b", END_OF_TIME, True)]
    assert len({r.key for r in dimension.collect()}) == 2
    assert single_open_version(dimension, "id").isEmpty()


def test_repeated_keys_and_earlier_looks_are_refused(spark):
    look = spark.sql("SELECT * FROM VALUES (1L, 'a') AS t(id, name)")
    history = open_versions(look, "id", datetime(2025, 2, 1))
    with pytest.raises(ValueError, match="not unique"):
        scd2_apply(history, look.union(look), "id", ["name"], datetime(2025, 3, 1))
    with pytest.raises(ValueError, match="later than this look"):
        scd2_apply(history, look, "id", ["name"], datetime(2025, 1, 1))
